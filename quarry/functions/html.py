"""D3: HTML → title, language, charset, plain text, with JVM-side regexes.

Only constructs shared by Java regexes and RE2 are used (no look-around,
no back-references), so SQL engines with RE2 compute the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values ----
# Entities decoded after tag removal (``&amp;`` last, so ``&amp;lt;``
# stays ``&lt;``); a no-break space counts as a space.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
            ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&bdquo;", "„"),
            ("&hellip;", "…"), ("&bull;", "•"), ("&middot;", "·"), ("&laquo;", "«"), ("&raquo;", "»"), ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"),
            ("&euro;", "€"), ("&pound;", "£"), ("&cent;", "¢"), ("&sect;", "§"), ("&deg;", "°"), ("&times;", "×"),
            ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"),
            ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"), ("&aacute;", "á"), ("&iacute;", "í"), ("&oacute;", "ó"), ("&uacute;", "ú"),
            ("&ccedil;", "ç"), ("&ntilde;", "ñ"), ("&amp;", "&")]
# ---- end of fixed values ----
WS = "[ \\t\\n\\r\\f]+"
NUMBER = "^([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"  # behind &#


def _numeric(c: Column) -> Column:
    """``&#8217;`` and ``&#x2019;``; a number that is no character becomes U+FFFD, an ampersand ``&amp;`` (decoded last)."""
    def one(p: Column) -> Column:
        m = F.regexp_extract(p, NUMBER, 1)
        code = F.when(F.lower(m).startswith("x"), F.conv(F.substr(m, F.lit(2)), 16, 10).cast("long")).otherwise(m.try_cast("long"))
        good = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = (F.when(code == 38, "&amp;").when(code == 160, " ")
                .when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd"))
        return F.when(m == "", F.concat(F.lit("&#"), p)).otherwise(F.concat(char, F.substr(p, F.length(m) + 2)))
    pieces = F.split(c, "&#")
    return F.when(F.contains(c, F.lit("&#")), F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")).otherwise(c)


def decode_entities(c: Column) -> Column:
    told = c
    for a, b in ENTITIES[:-1]:
        told = F.replace(told, F.lit(a), F.lit(b))
    told = F.replace(_numeric(told), F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))
    return F.when(F.contains(c, F.lit("&")), told).otherwise(c)


def collapse_ws(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, WS, " "), F.lit(" "))


def title(html: Column) -> Column:
    t = F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(t != "", collapse_ws(decode_entities(t)))


def lang(html: Column) -> Column:
    v = F.regexp_extract(html, "(?is)<html[^>]*[ \\t\\n]lang=\"([^\"]*)\"", 1)
    return F.when(v != "", F.lower(v))


def charset(html: Column) -> Column:
    v = F.regexp_extract(html, "(?is)<meta[^>]*charset=\"?([A-Za-z0-9_-]+)", 1)
    return F.when(v != "", F.lower(v))


def body_text(html: Column) -> Column:
    """Visible text: drop comments, scripts, styles (up to the end where one isn't
    closed), the head, then tags; decode entities; collapse white space."""
    t = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", " ")
    t = F.regexp_replace(t, r"(?is)<script[^>]*>.*?(?:</script>|\z)", " ")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?(?:</style>|\z)", " ")
    t = F.regexp_replace(t, "(?is)<head[^>]*>.*?</head>", " ")
    t = F.regexp_replace(t, "<[^>]*>", " ")
    return collapse_ws(decode_entities(t))

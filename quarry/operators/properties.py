"""Property mapping (J3 M8 M9 M10 M11 F11 X14 D2): ordered extracted
properties → mapped properties, in-row with higher-order functions.

Rules are configuration. They become a map literal, so a lookup is a
JVM-side expression inside ``transform`` — no join, no shuffle.
"""

from __future__ import annotations

import itertools
from typing import Callable

from pyspark.sql import Column, functions as F

from quarry.functions import meta
from quarry.functions.text import ascii_lower, escape_html

# ---- fixed values ----
# Built-in property rules, in the reference's order. Action "drop"
# discards the property, "plain" maps it trivially, "display" maps it
# under the given display tag. (The reference's declared value kinds
# have no effect and are not kept.)
BUILTIN_RULES = [
    ("ICC:Green TRC", "drop", None),
    ("ICC:Blue TRC", "drop", None),
    ("ICC:Red TRC", "drop", None),
    ("File Name", "drop", None),
    ("X-TIKA:content", "drop", None),
    ("X-TIKA:content_handler", "plain", None),
    ("X-TIKA:Parsed-By", "plain", None),
    ("X-TIKA:origResourceName", "plain", None),
    ("X-TIKA:sourcePath", "plain", None),
    ("Content-Type-Hint", "plain", None),
    ("Content-Type-Override", "plain", None),
    ("Content-Type-Parser-Override", "plain", None),
    ("dc:contributor", "display", "dc-contributor"),
    ("dc:coverage", "display", "dc-coverage"),
    ("dcterms:created", "plain", None),
    ("dc:creator", "plain", None),
    ("dc:date", "display", "dc-date"),
    ("dc:description", "plain", None),
    ("dc:format", "plain", None),
    ("dc:identifier", "display", "Identifier"),
    ("dc:language", "plain", None),
    ("dcterms:modified", "plain", None),
    ("dc:publisher", "display", "dc-publisher"),
    ("dc:relation", "display", "dc-relation"),
    ("dc:rights", "display", "dc-rights"),
    ("dc:source", "display", "dc-source"),
    ("dc:subject", "plain", None),
    ("dc:type", "display", "dc-type"),
    ("dc:title", "plain", None),
    ("geo:lat", "display", "GPSLatitude"),
    ("geo:long", "display", "GPSLongitude"),
    ("geo:alt", "display", "GPSAltitude"),
    ("xmp:About", "plain", None),
    ("xmp:Advisory", "plain", None),
    ("xmp:CreateDate", "plain", None),
    ("xmp:CreatorTool", "plain", None),
    ("xmp:Identifier", "display", "Identifier"),
    ("xmp:Label", "display", "Label"),
    ("xmp:MetadataDate", "display", "DateTimeMetadata"),
    ("xmp:ModifyDate", "plain", None),
    ("xmp:NickName", "display", "Nickname"),
    ("xmp:Rating", "display", "Rating"),
    ("xmpTPg:NPages", "plain", None),
    ("meta:author", "plain", None),
    ("meta:character-count", "plain", None),
    ("meta:character-count-with-spaces", "plain", None),
    ("meta:creation-date", "plain", None),
    ("meta:image-count", "plain", None),
    ("meta:initial-author", "plain", None),
    ("meta:keyword", "drop", None),
    ("meta:last-author", "plain", None),
    ("meta:line-count", "plain", None),
    ("meta:mapi-from-representing-name", "plain", None),
    ("meta:mapi-from-representing-email", "plain", None),
    ("meta:mapi-message-class", "plain", None),
    ("meta:mapi-msg-client-submit-time", "plain", None),
    ("meta:mapi-sent-by-server-type", "plain", None),
    ("meta:object-count", "plain", None),
    ("meta:page-count", "plain", None),
    ("meta:paragraph-count", "plain", None),
    ("meta:print-date", "plain", None),
    ("meta:save-date", "plain", None),
    ("meta:slide-count", "plain", None),
    ("meta:table-count", "plain", None),
    ("meta:word-count", "plain", None),
    ("cp:category", "plain", None),
    ("cp:contentStatus", "plain", None),
    ("cp:lastModifiedBy", "plain", None),
    ("cp:lastPrinted", "plain", None),
    ("cp:revision", "plain", None),
    ("cp:version", "plain", None),
    ("cp:subject", "drop", None),
    ("extended-properties:Template", "plain", None),
    ("extended-properties:Manager", "plain", None),
    ("extended-properties:Company", "plain", None),
    ("extended-properties:PresentationFormat", "plain", None),
    ("extended-properties:Notes", "plain", None),
    ("extended-properties:TotalTime", "plain", None),
    ("extended-properties:HiddedSlides", "plain", None),
    ("extended-properties:Application", "plain", None),
    ("extended-properties:AppVersion", "plain", None),
    ("extended-properties:DocSecurity", "plain", None),
    ("extended-properties:DocSecurityString", "plain", None),
    ("w:Comments", "display", "UserComment"),
    ("pdf:docinfo:created", "plain", None),
    ("pdf:docinfo:creator", "plain", None),
    ("pdf:docinfo:creator_tool", "plain", None),
    ("pdf:docinfo:modified", "plain", None),
    ("pdf:docinfo:keywords", "plain", None),
    ("pdf:docinfo:producer", "plain", None),
    ("pdf:docinfo:subject", "plain", None),
    ("pdf:docinfo:title", "plain", None),
    ("pdf:docinfo:trapped", "plain", None),
    ("pdf:PDFVersion", "plain", None),
    ("pdfa:PDFVersion", "plain", None),
    ("pdf:PDFExtensionVersion", "plain", None),
    ("pdfaid:conformance", "plain", None),
    ("pdfaid:part", "plain", None),
    ("pdf:encrypted", "plain", None),
    ("pdf:producer", "plain", None),
    ("pdf:actionTrigger", "plain", None),
    ("pdf:charsPerPage", "plain", None),
    ("pdf:unmappedUnicodeCharsPerPage", "plain", None),
    ("pdf:hasXFA", "plain", None),
    ("pdf:hasXMP", "plain", None),
    ("pdf:xmpLocation", "plain", None),
    ("pdf:hasAcroFormFields", "plain", None),
    ("pdf:hasMarkedContent", "plain", None),
    ("pdf:hasCollection", "plain", None),
    ("pdf:embeddedFileDescription", "plain", None),
]
# Host default list of metadata fields shown expanded (lower-case tags).
DEFAULT_VISIBLE_FIELDS = [
    "make", "model", "datetimeoriginal", "exposuretime", "fnumber",
    "isospeedratings", "focallength", "artist", "copyright",
    "imagedescription", "gpslatitude", "gpslongitude", "gpsaltitude",
]
# ---- end of fixed values ----

# Value formatters by name: (format_tag Column, value Column) -> Column.
FORMATTERS: dict[str, Callable[[Column, Column], Column]] = {
    "identity": lambda tag, v: v,
}


# Property processors by name: (name, values, *args) Columns and literals -> struct<name, values,
# visibility_tag, id>, or NULL to discard the property.
PROCESSORS: dict[str, Callable[..., Column]] = {}


def register_processor(name: str, fn: Callable[..., Column]) -> None:
    """Register a processor that rules name with ``{"formatter": name, "args": [...]}``."""
    PROCESSORS[name] = fn


def processed(name: Column, values: Column, tag: Column) -> Column:
    """The struct that a processor returns: shown name, values, and the tag that tells visibility and element id."""
    return F.struct(name.alias("name"), values.alias("values"), ascii_lower(tag).alias("visibility_tag"),
                    F.concat(F.lit(meta.ID_PREFIX), ascii_lower(tag)).alias("id"))


def register_formatter(name: str, fn: Callable[[Column, Column], Column]) -> None:
    """Register a value formatter built from Column expressions."""
    FORMATTERS[name] = fn


# Value formatters over whole Arrow batches: (format tags, values) -> formatted values, arrays of equal length.
BATCH_FORMATTERS: dict[str, Callable] = {}


def register_batch_formatter(name: str, fn: Callable) -> None:
    """Register a formatter that gets the values of all properties of a batch as one Arrow array, with their format
    tags as another, and returns an array of as many strings. It runs in Python workers and must not need this package."""
    BATCH_FORMATTERS[name] = fn


MAPPED = "array<struct<pos: int, name: string, values: array<string>, visibility_tag: string, id: string>>"


def _in_batches(fn: Callable) -> Callable[[Column], Column]:
    """Mapped properties with a field ``fmt`` (null: leave the values) to mapped properties: all values are laid end to
    end, formatted at once, and cut again by the offsets they had."""
    def run(props):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def lengths(x):
            return pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64)

        def listed(x, like):
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths(like))]), pa.int32())
            return pa.ListArray.from_arrays(ends, x, mask=pc.is_null(like) if like.null_count else None)

        if isinstance(props, pa.ChunkedArray):
            props = props.combine_chunks()
        flat = props.flatten()
        told = dict(zip((f.name for f in flat.type), flat.flatten()))
        values = told["values"].flatten()
        tags = told["fmt"].take(pa.array(np.repeat(np.arange(len(flat)), lengths(told["values"]))))
        wanted = pc.is_valid(tags)
        done = fn(tags.filter(wanted), values.filter(wanted))
        if len(done) != pc.sum(wanted).as_py() if len(wanted) else len(done):
            raise ValueError("a formatter returns as many values as it gets")
        told["values"] = listed(pc.replace_with_mask(values, wanted, done.cast(values.type)), told["values"])
        names = ["pos", "name", "values", "visibility_tag", "id"]
        return listed(pa.StructArray.from_arrays([told[n] for n in names], names=names), props)

    return F.arrow_udf(run, MAPPED)


class RuleSet:
    """Effective rule lookup (J3): user exact → user ``!`` → built-in exact →
    user ``*`` → plain. User rules: name → False (drop) | True (plain) | tag |
    (tag[, format_tag]) | {"formatter": processor, "args": [...]}."""

    def __init__(self, user: dict | None = None, builtin=BUILTIN_RULES,
                 labels: dict | None = None, formatter: str = "identity"):
        user = dict(user or {})
        self.named: list = []  # (processor, args) of the rules that name one
        self.labels = dict(labels or {})
        self.formatter = formatter
        self.bang = self._norm(user.pop("!")) if "!" in user else None
        self.star = self._norm(user.pop("*")) if "*" in user else None
        table = {n: (a, t, None) for n, a, t in builtin}
        if self.bang is not None:
            table = {}  # '!' outranks every built-in entry
        for n, v in user.items():
            table[n] = self._norm(v)
        self.table = table

    def _norm(self, v):
        if isinstance(v, dict):
            if v.get("formatter") not in PROCESSORS:
                raise ValueError(f"property rule names an unknown formatter: {v!r}")
            self.named.append((PROCESSORS[v["formatter"]], list(v.get("args", ()))))
            return (f"named:{len(self.named) - 1}", None, None)
        if v is False:
            return ("drop", None, None)
        if v is True:
            return ("plain", None, None)
        if isinstance(v, (tuple, list)):
            tag = v[0]
            fmt = v[1] if len(v) > 1 else None
            return ("display", tag, fmt)
        if isinstance(v, str):
            return ("display", v, None)
        raise TypeError(f"bad property rule {v!r}")

    def _rule_struct(self, r):
        a, t, f = r
        return F.struct(F.lit(a).alias("action"), F.lit(t).cast("string").alias("tag"),
                        F.lit(f).cast("string").alias("fmt"))

    def lookup(self, name: Column) -> Column:
        """Rule struct ``(action, tag, fmt)`` for a property name."""
        fallback = self.bang or self.star or ("plain", None, None)
        if not self.table:
            return self._rule_struct(fallback)
        act, tag, fmt = self._maps()
        hit = F.try_element_at(act, name)
        return F.when(hit.isNull(), self._rule_struct(fallback)).otherwise(F.struct(
            hit.alias("action"), F.try_element_at(tag, name).alias("tag"), F.try_element_at(fmt, name).alias("fmt")))

    def _maps(self):
        """Three map literals name → action / tag / format tag, built with
        one array literal each (cheap to build, folded to constants)."""
        if getattr(self, "_cached_maps", None) is None:
            names = list(self.table)
            cols = list(zip(*[self.table[n] for n in names]))
            keys = F.lit(names)
            self._cached_maps = tuple(
                F.map_from_arrays(keys, F.lit(list(c)).cast("array<string>")) for c in cols)
        return self._cached_maps

    def display_name(self, tag: Column) -> Column:
        """Localised label for ``exif-<tag>`` if known, else the escaped tag."""
        if not self.labels:
            return escape_html(tag)
        m = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v)) for k, v in self.labels.items()))
        return F.coalesce(F.try_element_at(m, F.concat(F.lit(meta.ID_PREFIX), ascii_lower(tag))), escape_html(tag))


def _mapped(p: Column, r: Column, rules: RuleSet) -> Column:
    """M9 / M10 for one property ``p`` under rule ``r`` (both field refs)."""
    batch = rules.formatter in BATCH_FORMATTERS
    fmt = FORMATTERS["identity" if batch else rules.formatter]
    tag = r["tag"]
    fmt_tag = F.coalesce(r["fmt"], tag)
    display = r["action"] == "display"
    own = F.struct(
        p["pos"].alias("pos"),
        F.when(display, rules.display_name(tag)).otherwise(escape_html(p["name"])).alias("name"),
        F.when(display, F.transform(p["values"], lambda v: fmt(fmt_tag, v)))
         .otherwise(F.transform(p["values"], lambda v: escape_html(v))).alias("values"),
        ascii_lower(F.when(display, tag).otherwise(p["name"])).alias("visibility_tag"),
        F.concat(F.lit(meta.ID_PREFIX), F.when(display, ascii_lower(tag)).otherwise(p["name"])).alias("id"),
        *([F.when(display, fmt_tag).alias("fmt")] if batch else []))
    for i, (fn, args) in enumerate(rules.named):
        done = fn(p["name"], p["values"], *args)
        done = F.when(done.isNotNull(), F.struct(p["pos"].alias("pos"), *[done[c].alias(c) for c in ("name", "values", "visibility_tag", "id")],
                                                     *([F.lit(None).cast("string").alias("fmt")] if batch else [])))
        own = F.when(r["action"] == f"named:{i}", done).otherwise(own)
    return own


def map_properties(props: Column, rules: RuleSet) -> Column:
    """M8 over an ordered property array (J3 lookup once per property);
    dropped properties (F11) are removed. Result elements:
    ``(pos, name, values, visibility_tag, id)``."""
    with_rule = F.transform(props, lambda p: F.struct(p.alias("p"), rules.lookup(p["name"]).alias("r")))
    kept = F.filter(with_rule, lambda x: x["r"]["action"] != "drop")
    mapped = F.transform(kept, lambda x: _mapped(x["p"], x["r"], rules))
    mapped = F.array_compact(mapped) if rules.named else mapped
    return _in_batches(BATCH_FORMATTERS[rules.formatter])(mapped) if rules.formatter in BATCH_FORMATTERS else mapped

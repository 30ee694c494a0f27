"""quarry: a Spark-native engine that turns collections of files into
search-ready text and displayable metadata.

Files are rows; routing, hashing, dedupe, result reuse, outcome folding,
property mapping and merging are DataFrame operators. See README.md.
"""

__version__ = "0.1.0"

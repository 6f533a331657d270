"""Label lines and class names, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The classes in label order, with what is spoken and the ratio of the sides.
CLASSES = [
    ("1000", "seribu rupiah", 121 / 65),
    ("2000", "dua ribu rupiah", 126 / 65),
    ("5000", "lima ribu rupiah", 131 / 65),
    ("10000", "sepuluh ribu rupiah", 136 / 65),
    ("20000", "dua puluh ribu rupiah", 141 / 65),
    ("50000", "lima puluh ribu rupiah", 146 / 65),
    ("100000", "seratus ribu rupiah", 151 / 65),
]
# Class of each id where a dataset states none.
DEFAULT_CLASS_IDS = {0: "20000", 1: "2000", 2: "50000", 3: "5000", 4: "10000", 5: "100000", 6: "1000"}
# A name with one of these is no note, unless it also holds a numeral or thousands form.
NOT_NOTES = ["koin", "logam", "coin", "other", "background", "belakang", "depan_belakang"]
# Parts of names by class, in the order in which they are tried.
NAME_PARTS = [
    ("100000", ["seratus", "100k", "100ribu", "100rb", "100.000", "100000"]),
    ("50000", ["lima puluh", "50k", "50ribu", "50rb", "50.000", "50000"]),
    ("20000", ["dua puluh", "20k", "20ribu", "20rb", "20.000", "20000"]),
    ("10000", ["sepuluh", "10k", "10ribu", "10rb", "10.000", "10000"]),
    ("5000", ["lima", "5k", "5ribu", "5rb", "5.000", "5000"]),
    ("2000", ["dua", "2k", "2ribu", "2rb", "2.000", "2000"]),
    ("1000", ["seribu", "1k", "1ribu", "1rb", "1.000", "1000"]),
]


def holds_any(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def normalize_class(name: Column) -> Column:
    """One of the classes, or null. The first family whose part the name holds decides."""
    s = F.trim(F.lower(name))
    numerals = [c for c, _, _ in CLASSES] + [f"{int(c) // 1000}k" for c, _, _ in CLASSES]
    digits = F.regexp_replace(s, "[^0-9]", "")
    found = F.when(name.isNull() | (name == "") | (holds_any(s, NOT_NOTES) & ~holds_any(s, numerals)), F.lit(None))
    for label, parts in NAME_PARTS:
        found = found.when(holds_any(s, parts), F.lit(label))
    for label, _, _ in CLASSES:
        found = found.when(digits.isin(label, str(int(label) // 1000)), F.lit(label))
    return found


def parse_label_line(line: Column) -> Column:
    """Struct of class id and box, or null for a line that isn't one.

    Four values are centre and size, an even number of six or more is a polygon; everything is clamped
    to the unit square and boxes thinner than 1e-4 are dropped.
    """
    parts = F.split(F.trim(line), r"\s+")
    class_id = F.when(parts[0].rlike(r"^[+-]?\d+$"), parts[0].try_cast("int"))
    values = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda v: v.try_cast("double"))
    n = F.size(values)
    usable = (n >= 4) & class_id.isNotNull() & ~F.exists(values, lambda v: v.isNull())
    every = lambda k: F.filter(values, lambda _, i: i % 2 == k)
    v = lambda i: F.get(values, F.lit(i))
    box = n == 4
    sides = [
        F.when(box, v(0) - v(2) / 2).otherwise(F.array_min(every(0))),
        F.when(box, v(1) - v(3) / 2).otherwise(F.array_min(every(1))),
        F.when(box, v(0) + v(2) / 2).otherwise(F.array_max(every(0))),
        F.when(box, v(1) + v(3) / 2).otherwise(F.array_max(every(1))),
    ]
    x0, y0, x1, y1 = (F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)) for s in sides)
    shaped = box | ((n >= 6) & (n % 2 == 0))
    wide = (x1 - x0 >= 1e-4) & (y1 - y0 >= 1e-4)
    return F.when(usable & shaped & wide, F.struct(class_id.alias("cls"), x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def lookup(entries: Column, key: Column, default: Column) -> Column:
    """The value of a key in a map, or a default where the map is null or has no such key."""
    return F.coalesce(F.try_element_at(entries, key), default)

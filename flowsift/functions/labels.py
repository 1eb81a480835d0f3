"""Label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsift.schema import BENIGN, LABELS

# Ordered (keyword, class) rules; the first keyword found in the label wins.
LABEL_RULES = (
    ("ddos", "DDoS"),
    ("dos", "DoS"),
    ("portscan", "PortScan"),
    ("port scan", "PortScan"),
    ("brute", "Brute Force"),
    ("patator", "Brute Force"),
    ("web attack", "Web Attack"),
    ("xss", "Web Attack"),
    ("sql injection", "Web Attack"),
    ("bot", "Botnet"),
    ("infiltration", "Infiltration"),
    ("heartbleed", "Infiltration"),
    ("benign", "BENIGN"),
)
UNKNOWN_ATTACK = "DoS"


def normalise_label(raw: Column) -> Column:
    """Granular label text to one of the eight classes; NULL and empty text count as benign."""
    text = F.lower(F.btrim(raw, F.lit(" \t\n\r\f\x0b")))
    matched = [F.when(F.contains(text, F.lit(word)), F.lit(cls)) for word, cls in LABEL_RULES]
    empty = F.when(text.isNull() | text.isin("", "nan"), F.lit(BENIGN))
    return F.coalesce(*matched, empty, F.lit(UNKNOWN_ATTACK))


def binary_target(label: Column) -> Column:
    return (label != F.lit(BENIGN)).cast("int")


def label_id(label: Column) -> Column:
    """Class id of a known label, NULL for an unknown one."""
    ids = F.create_map(*[F.lit(v) for i, name in enumerate(LABELS) for v in (name, i)])
    return F.element_at(ids, label)


def label_name(class_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in LABELS]), (class_id + 1).cast("int"))


def attack_score(probabilities: Column, classes: list[int] | None = None) -> Column:
    """1 - P(BENIGN); 1.0 when the model never saw a benign row.

    ``classes`` gives the class id of every array position (default: all ids in order).
    """
    ids = list(range(len(LABELS))) if classes is None else list(classes)
    if 0 not in ids:
        return F.lit(1.0)
    return F.lit(1.0) - F.element_at(probabilities, ids.index(0) + 1)


def predicted_class(probabilities: Column, classes: list[int] | None = None) -> Column:
    """Class id with the highest probability, the first one on ties."""
    best = F.array_position(probabilities, F.array_max(probabilities)).cast("int")
    if classes is None:
        return best - 1
    return F.element_at(F.array(*[F.lit(c) for c in classes]), best)

"""Sentiment labels, confidences and product keys as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label ids and accepted spellings.
ID_LABELS = {0: "NEG", 1: "NEU", 2: "POS"}
SYNONYMS = {
    "POS": "POS", "POSITIVE": "POS", "+": "POS", "2": "POS",
    "NEG": "NEG", "NEGATIVE": "NEG", "-": "NEG", "0": "NEG",
    "NEU": "NEU", "NEUTRAL": "NEU", "1": "NEU",
}


def _map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def label_from_id(label: Column, pred_id: Column) -> Column:
    """The label, or the one of the id where there is none."""
    return F.coalesce(label, _map(ID_LABELS)[pred_id.cast("int")])


def confidence(value: Column, *probabilities: Column) -> Column:
    """The confidence, or the greatest probability where there is none."""
    return F.coalesce(value, F.greatest(*probabilities))


def argmax(neg: Column, neu: Column, pos: Column) -> Column:
    """The label of the greatest probability; of equal ones NEG comes before NEU before POS."""
    return F.when((neg >= neu) & (neg >= pos), "NEG").when(neu >= pos, "NEU").otherwise("POS")


def normal_sentiment(raw: Column) -> Column:
    """Any accepted spelling to a label; what is unknown or null is neutral."""
    return F.coalesce(_map(SYNONYMS)[F.coalesce(F.upper(F.trim(raw)), F.lit(""))], F.lit("NEU"))


def fuzzy_label(raw: Column) -> Column:
    """The label that a teacher's reply contains."""
    up = F.upper(raw)
    return F.when(up.contains("POS"), "POS").when(up.contains("NEG"), "NEG").otherwise("NEU")


def product_id(brand: Column, model: Column) -> Column:
    """brand__model, or the one that isn't blank, or unknown_product."""
    b, m = (F.nullif(F.trim(c), F.lit("")) for c in (brand, model))
    return F.coalesce(F.concat(b, F.lit("__"), m), b, m, F.lit("unknown_product"))


def weight(raw: Column) -> Column:
    """A whole weight, 1 where it is no number."""
    return F.coalesce(raw.try_cast("double"), F.lit(1.0)).cast("long")


def counts(label: Column, by: Column | None = None) -> list[Column]:
    """pos_cnt, neu_cnt, neg_cnt and total_cnt; `by` is a weight."""
    by = F.lit(1) if by is None else by
    return [
        *(F.coalesce(F.sum(F.when(label == x, by)), F.lit(0)).cast("long").alias(f"{x.lower()}_cnt") for x in ("POS", "NEU", "NEG")),
        F.coalesce(F.sum(by), F.lit(0)).cast("long").alias("total_cnt")]

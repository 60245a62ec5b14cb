"""Column functions over labels and model scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings of a label.
LABEL_SPELLINGS = {"1": 1, "true": 1, "yes": 1, "0": 0, "false": 0, "no": 0}

# Columns beside the text that the classifier reads.
META_COLUMNS = (
    "has_mesh_consciousness_major",
    "has_mesh_consciousness",
    "has_mesh_spirit_religion",
    "n_mesh",
)


def label_key(raw: Column | str) -> Column:
    """The spelling a raw label is looked up by."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.lower(F.regexp_replace(raw.cast("string"), r"(?U)^\s+|\s+$", ""))


def label_in_set(raw: Column | str) -> Column:
    """True where the raw label is one of the accepted spellings."""
    return F.coalesce(label_key(raw).isin(*LABEL_SPELLINGS), F.lit(False))


def normalize_label(raw: Column | str) -> Column:
    """0, 1, or null for any other spelling."""
    key = label_key(raw)
    ones = [s for s, v in LABEL_SPELLINGS.items() if v == 1]
    zeros = [s for s, v in LABEL_SPELLINGS.items() if v == 0]
    return F.when(key.isin(*ones), 1).when(key.isin(*zeros), 0).cast("int")


def normalize_label_strict(df: DataFrame, label: str = "label") -> DataFrame:
    """Normalise the label column and keep only the rows with an accepted label."""
    return df.withColumn(label, normalize_label(label)).filter(F.col(label).isNotNull())


def build_meta(df: DataFrame, columns=META_COLUMNS) -> DataFrame:
    """The numeric features as doubles, null as 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def predicted(prob: Column | str = "model_prob", threshold: float = 0.5) -> Column:
    prob = F.col(prob) if isinstance(prob, str) else prob
    return (prob >= threshold).cast("int")


def score_columns(df: DataFrame, prob: str = "model_prob", label: str | None = "label", threshold: float = 0.5) -> DataFrame:
    """Add ``pred``, ``abs_margin`` and, where there is a label, ``mismatch``."""
    added = {"pred": predicted(prob, threshold), "abs_margin": F.abs(F.col(prob) - threshold)}
    if label is not None:
        # A row without a label cannot agree with its prediction.
        added["mismatch"] = ~predicted(prob, threshold).eqNullSafe(F.col(label))
    return df.withColumns(added)

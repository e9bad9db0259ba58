"""Brute-force versions and small tables for the tests of this folder."""

import re

import numpy as np
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("ash bay cod dew elm fir gum hay ivy jam kelp lime moss nut oak pine quay reed sage teal umber vine wax yew "
         "zinc amber birch cedar dune ember").split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[k] for k in rng.integers(0, len(WORDS), n))


def docs_of(spark, texts, langs=None, sources=None, ids=None):
    rows = [(ids[k] if ids else k, t, langs[k] if langs else "en", sources[k] if sources else f"s{k % 2}", None)
            for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def with_clashes(df):
    """Extra columns whose names the operators use inside."""
    names = ("id", "ord", "size", "words", "n_words", "h", "kept_", "g", "data", "path", "part", "component", "key", "bucket",
             "rank", "weight", "target_", "spans", "n_tokens_", "_text", "_group", "w", "mark")
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)

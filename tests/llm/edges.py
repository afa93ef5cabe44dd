"""A table with the cases every operator must bear: nulls in any column, empty and
very long texts, ties, repeated rows, and extra columns whose names clash."""

from __future__ import annotations

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
CLASHING = ("score", "shard", "slot", "size", "fp", "label", "component_id", "key", "overlap", "secrets", "ids",
            "text_key", "kept_key", "row", "quality_score", "benchmark_overlap", "secret_spans", "n_words", "start")
LONG = " ".join(f"word{i % 977} and some, more." for i in range(40_000)) + " token = \"abcdef123456\""
TEXTS = [(None, "a row without an id"), (1, None), (2, ""), (3, "twice the same row is here"),
         (3, "twice the same row is here"), (4, LONG), (5, "x" * 200_000), (6, "tie of texts"), (7, "tie of texts"),
         (8, " \n\t \r\n "), (9, "Über 日本語 𝒳 été ß token: 'secret99'"), (None, None), (10, "one"),
         (11, "\x00 nul and \x1c others"), (12, "same id, first"), (12, "same id, second")]


def edge_docs(spark):
    rows = [(d, t, None if k % 3 else "en", None if k % 2 else f"s{k}", None if k % 4 else len(t or ""),
             *[f"c{k}"] * len(CLASHING)) for k, (d, t) in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + \
        ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def no_docs(spark):
    return edge_docs(spark).limit(0)


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t) for k, t in enumerate(texts)], "doc_id long, text string")

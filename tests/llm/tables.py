"""Small tables with awkward rows for the corpus queries, written as Parquet."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq

EN = "the quick brown fox jumps over the lazy dog and then it was the end of the story with other words"
DE = "der schnelle braune fuchs springt über den faulen hund und dann war es das ende der geschichte"
BENCH = "What is the airspeed velocity of an unladen swallow over the channel in winter, and why?"

#: doc_id, text, lang, source: nulls in every column, empty and long texts, ties, repeated rows.
ROWS = [
    (1, EN, "en", "a"), (2, EN, "en", "a"), (3, EN + " indeed", "en", "b"), (4, DE, "de", "b"),
    (5, DE + " nochmals", "de", None), (6, "", "en", "c"), (7, None, None, "c"), (None, EN, None, None),
    (8, "12 34 !!", None, "d"), (9, "x", "en", "d"), (10, "long " * 60_000 + EN, "en", "a"),
    (11, "w" * 300_000, None, "b"), (12, DE, "de", "b"), (12, DE, "de", "b"), (12, DE, "de", "b"),
    (13, f"intro words here. {BENCH} and more after it", "en", "a"), (None, None, None, None),
    (14, "you stupid worthless trash, what a clown", "en", "a"), (15, "mail me at jane.doe@example.org now", "en", "c"),
    (16, "\t\n \r\x0b\x0c", "en", "c"), (17, "É́ 日本語 текст <|endoftext|> 'll", "xx", "e"),
]


def documents(rows=ROWS) -> pa.Table:
    ids, texts, langs, sources = zip(*rows) if rows else ((), (), (), ())
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()),
        "source": pa.array(sources, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
        # extra columns with names that results use
        **{c: pa.array([c] * len(ids), pa.string()) for c in (
            "size", "shard", "slot", "rank", "score", "label", "fp", "tag", "copies", "target", "n_tokens", "found",
            "root", "source_size", "held_out", "item_id", "distance", "block", "query_id", "toxic")}})


def write(path, rows=ROWS, benchmark=((1, BENCH), (2, None), (3, ""), (4, "..."), (1, BENCH)),
          labels=((1, 0), (14, 1), (3, 0), (4, None), (None, 1), (14, 1)), pages=(), vectors=()) -> str:
    """A folder like the given ones; returns its path."""
    path = str(path)
    tables = {
        "documents": documents(rows),
        "benchmark": pa.table({"item_id": pa.array([i for i, _ in benchmark], pa.int64()),
                               "text": pa.array([t for _, t in benchmark], pa.string()),
                               "doc_id": pa.array([-1 for _ in benchmark], pa.int64())}),
        "labels": pa.table({"doc_id": pa.array([i for i, _ in labels], pa.int64()),
                            "toxic": pa.array([t for _, t in labels], pa.int32()),
                            "quality": pa.array([1 for _ in labels], pa.int32()),
                            "text": pa.array(["label text" for _ in labels], pa.string())}),
        "pages": pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()),
                           "url": pa.array([p[1] for p in pages], pa.string()),
                           "html": pa.array([p[2] for p in pages], pa.string()),
                           "text": pa.array(["not this" for _ in pages], pa.string())}),
        "embeddings": pa.table({"vec_id": pa.array([v[0] for v in vectors], pa.int64()),
                                "embedding": pa.array([v[1] and [None if x is None else float(x) for x in v[1]] for v in vectors],
                                                      pa.list_(pa.float32())),
                                "label": pa.array([0 for _ in vectors], pa.int32()),
                                "vector": pa.array(["v" for _ in vectors], pa.string()),
                                "score": pa.array([0.5 for _ in vectors], pa.float64())}),
    }
    for name, table in tables.items():
        pq.write_table(table, os.path.join(path, f"{name}.parquet"))
    return path

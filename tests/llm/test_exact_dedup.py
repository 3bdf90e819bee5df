import hashlib
import re

import pytest
from pyspark.sql import functions as F

from holdfast.llm import exact_dedup as E


def expected(rows):
    groups = {}
    for r in rows:
        body = r.text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", body), []).append((-len(body), r.doc_id is None, r.doc_id or 0, r.doc_id))
    out = []
    for body, members in groups.items():
        best = min(members)
        for chars, _, _, doc_id in members:
            out.append((doc_id, best[3], len(members), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("sizes", [{}, {"table_bytes": 30_000, "fanout": 2}])  # small tables spill level by level
def test_against_brute_force(edges, documents, sizes):
    for docs in (edges, documents.limit(150)):
        docs = docs.cache()
        found = E.mark_duplicates(docs, **sizes).collect()
        want, n_groups = expected(docs.collect())
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == want
        kept = [r for r in found if r.kept]
        assert len(kept) == n_groups == len({r.text_sha256 for r in kept})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_rows_that_stay_keep_their_columns(edges):
    found = E.drop_duplicates(edges)
    assert found.columns == edges.columns
    _, n_groups = expected(edges.collect())
    assert found.count() == n_groups


def test_empty(empty):
    assert E.mark_duplicates(empty).count() == 0 and E.drop_duplicates(empty).count() == 0


def test_equal_hashes_are_told_apart_by_content():
    table = E.ContentTable()
    for content in (b"a", b"b", b"a"):
        table.add(7, content, 1, 1, None)
    assert table.contents == [b"a", b"b"] and table.counts == [2, 1]
    for k in range(5000):  # grows
        table.add(k * 1024, str(k).encode(), 1, 1, k)
    assert len(table.contents) == 5002


def test_many_copies_of_one_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.col("id").cast("string")).alias("text"))
    found = E.mark_duplicates(docs, table_bytes=100, fanout=2)
    assert found.where("keep_id = 0").agg(F.max("group_size"), F.count("*")).first()[:] == (1000, 1000)
    assert found.where("kept").count() == 2001

from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from holdfast.llm import filter_audit as A

from .conftest import SCHEMA, WORD, rows_of


def fails(text):
    words = WORD.findall(text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }


def expected(rows, labels):
    """Every filter applied to every document in every order."""
    docs = []
    for r in rows:
        again = r[0] is not None and any(x[0] is not None and x[0] < r[0] and (x[1] or "") == (r[1] or "") for x in rows)
        marks = [x for x in labels if x[0] is not None and x[0] == r[0]]
        docs.append((r[3] or "", fails(r[1] or "") | {"E": again}, any(x[1] == 1 for x in marks), any(x[2] == 1 for x in marks)))
    out, removed = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                all_fail = sum(d[0] == part and d[1][f] for d in docs)
                only = sum(d[0] == part and d[1][f] and sum(d[1].values()) == 1 for d in docs)
                out[part, order, step] = [len(left), len(gone), all_fail - len(gone), only, sum(d[2] for d in gone), sum(d[3] for d in gone)]
                removed[part, f] = removed.get((part, f), 0) + len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(docs, labels):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in A.audit(docs, labels).collect()}


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_equals_every_filter_applied(spark, documents):
    rows = [tuple(r) for r in documents.limit(60).collect()]
    rows += [(10**6 + r[0], *r[1:]) for r in rows[:12]]  # copies
    rows = [(r[0], r[1], r[2], "s" + str(k % 3), *r[4:]) for k, r in enumerate(rows)]
    marks = [(r[0], k % 2, k % 3 == 0, None) for k, r in enumerate(rows[::2])]
    marks = [(a, b, int(c), d) for a, b, c, d in marks] + [(rows[0][0], 1, 1, "x"), (None, 1, 1, None)]
    got = found(spark.createDataFrame(rows, documents.schema), labelled(spark, marks))
    assert got == expected(rows, marks)


def test_edges(spark, edges, empty):
    marks = [(0, 1, None, ""), (0, None, 1, ""), (3, 0, 0, ""), (None, 1, 1, "")]
    got = found(edges, labelled(spark, marks))
    assert got == expected([tuple(r) for r in edges.collect()], marks)
    assert "" in {k[0] for k in got}
    assert A.audit(empty, labelled(spark, marks)).count() == 0
    assert len(found(edges, labelled(spark, []))) == len(got)


def test_equal_rows_and_rows_without_id_are_linear(spark):
    """Many rows without id, and many of one id, share a text."""
    from pyspark.sql import functions as F

    n = 100_000
    docs = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lit("same Text").alias("text"), F.lit(None).cast("string").alias("source")
    )
    got = {r.step: r for r in A.audit(docs, labelled(spark, [(7, 1, 0, "")])).where("filter_order = 'EACBD'").collect()}
    assert got[1].removed == 0 and got[2].removed == n and got[2].good_lost == n // 2 and got[3].redundant == n


@pytest.mark.parametrize("n", [2, 3, 5])
def test_least_squares_gives_shapley_values(n):
    """The solved matrix has the weights s!(n-s-1)!/n! of marginal removals."""
    matrix = A.shapley_matrix(n)
    for i in range(n):
        for s in range(1, 1 << n):
            size = s.bit_count()
            if s >> i & 1:
                want = Fraction(factorial(size - 1) * factorial(n - size), factorial(n))
            else:
                want = -Fraction(factorial(size) * factorial(n - size - 1), factorial(n))
            assert matrix[i][s] == want
    assert A.solved([[0, 2], [1, 1]], [[4], [3]]) == [[1], [2]]

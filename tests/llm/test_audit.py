"""The filter audit against a plain version that runs every order document by document."""

from __future__ import annotations

import collections
import itertools
import re

import pytest
from pyspark.sql import functions as F

from mercato.llm import audit
from mercato.session import configure


@pytest.fixture(autouse=True)
def _configured(spark):
    configure(spark)


def failures(rows: list[tuple]) -> list[set[str]]:
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        out.append({f for f, bad in fails.items() if bad})
    return out


def plain(rows, failed, names, good, toxic):
    out = {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, failed, strict=True) if (p or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations(names):
            alive = mine
            for step, name in enumerate(order, 1):
                removed = [(i, f) for i, f in alive if name in f]
                before = len(mine) - len(alive)
                alive = [(i, f) for i, f in alive if name not in f]
                redundant = sum(name in f for _, f in mine) - len(removed)
                assert before >= redundant
                shapley[name] += len(removed)
                lost = [sum(i in marked for i, _ in removed) for marked in (good, toxic)]
                out[part, "".join(order), step] = [len(alive), len(removed), redundant, sum(f == {name} for _, f in mine), *lost, name]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


LONG = " ".join(f"w{n}" for n in range(120))
ROWS = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG, None), (None, LONG, "en"), (None, LONG, "en"), (1, LONG, "en"), (1, LONG, ""), (9, None, "en"), (8, "", "en"),
    (7, "", "fr"), (10, LONG + " #", "en"), (11, LONG + " #", "en"), (12, "SHOUT " * 150, "de"), (13, "a a b", "de"), (14, "É" * 12, None),
    (15, LONG.upper(), "de"), (16, LONG + "\x0b|\xa0", "en"), (17, "x" * 50_000, "fr"), (18, "tab\tsep " * 100, "fr"), (None, None, None), (19, LONG + " ", "xx"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (10, 1, 1), (12, None, 1), (None, 1, 1), (13, 0, 0), (99, 1, 1), (15, 1, 0)]


def test_audit_agrees_with_every_order_run(spark):
    docs = spark.createDataFrame([(*r, 5, 6, "n", "k") for r in ROWS], "doc_id long, text string, lang string, n long, mask int, part string, print string").repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    cells = audit.failure_cells(docs, labels)
    assert cells.agg(F.sum("n")).first()[0] == len(ROWS)
    out = audit.audit_orders(cells, "ABCDE").collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (*audit.COUNTS, "shapley")] for r in out}
    want = plain(ROWS, failures(ROWS), "ABCDE", {i for i, q, _ in LABELS if q == 1 and i}, {i for i, _, t in LABELS if t == 1 and i})
    assert len(out) == len(got) == 600 * 5 and got == want
    # every order removes the same documents in the end
    for part in {p for p, _, _ in got}:
        assert len({got[part, o, 5][0] for _, o, s in got if s == 5}) == 1


def test_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(i, "t" * i, "en") for i in range(10)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = audit.failure_cells(docs, labels, filters={"short": F.length("text") < 4, "odd": F.when(F.col("doc_id") != 3, F.col("doc_id") % 2 == 1)}, copies=None)
    out = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in audit.audit_orders(cells, ["s", "o"]).collect()}
    assert out == {("so", 1): (6, 4, 0, 3, 7), ("so", 2): (3, 3, 1, 3, 7), ("os", 1): (6, 4, 0, 3, 7), ("os", 2): (3, 3, 1, 3, 7)}
    with pytest.raises(ValueError):
        audit.audit_orders(cells, "ABCDEFGH")


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_orders(audit.failure_cells(docs, labels), "ABCDE").collect() == []


def test_audit_folds_without_python_and_without_cross_joins(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    plan = audit.audit_orders(audit.failure_cells(docs, labels), "ABCDE")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))

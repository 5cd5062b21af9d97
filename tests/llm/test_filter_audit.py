"""The audit against plain application of every order, and its edge cases."""

import itertools
import math
import random
import re

import pytest

from notelake.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """{(part, order, step): values} by running every order over the documents."""
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            text = text or ""
            least[text] = min(doc_id, least.get(text, doc_id))
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        failed = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search("[#$%&*|]", text), doc_id is not None and least[text] < doc_id)) if bad}
        known = [x for x in labels if doc_id is not None and x[0] == doc_id]
        rows.append((lang or "", failed, any(x[1] == 1 for x in known),
                     any(x[2] == 1 for x in known)))
    out, total = {}, {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                failing = sum(1 for r in rows if r[0] == part and f in r[1])
                left = [r for r in left if f not in r[1]]
                total[part, f] = total.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), failing - len(gone),
                    sum(1 for r in rows if r[0] == part and r[1] == {f}),
                    sum(r[2] for r in gone), sum(r[3] for r in gone))
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def collected(frame):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in frame.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(240):
        size = rng.choice([0, 20, 99, 100, 150])
        some = [rng.choice(words[:rng.choice([60, 300])]) for _ in range(size)]
        if rng.random() < 0.3:
            some = [w.upper() for w in some]
        if rng.random() < 0.3:
            some.append(rng.choice("#$%&*|"))
        docs.append((i, " ".join(some), rng.choice(["en", "de", None, ""])))
    docs += [(i, docs[3][1], "en") for i in range(300, 420)]  # a group of copies
    docs += [(None, docs[3][1], "en")] * 2 + [(2, docs[2][1], "de")] * 2 + [(500, None, "fr")]
    labels = [(rng.randrange(420), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(300)]
    labels += [(None, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    """With columns whose names the operator uses for itself."""
    return (spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr(
                "*", "1 as mask", "2 as part", "3 as n", "4 as words", "5 as digest"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr(
                "*", "1 as n", "2 as first"))


def test_every_order_by_brute_force(spark, tables):
    found = filter_audit.audit_filters(*frames(spark, *tables))
    wanted = plain(*tables)
    assert found.count() == len(wanted) == 4 * 120 * 5
    assert collected(found) == wanted


def test_empty_tables_and_no_labels(spark, tables):
    docs, labels = frames(spark, *tables)
    assert filter_audit.audit_filters(docs.limit(0), labels).collect() == []
    assert collected(filter_audit.audit_filters(docs, labels.limit(0))) == plain(tables[0], [])


def test_a_very_long_text(spark):
    long = "abc DEF " * 1_500_000
    found = collected(filter_audit.audit_filters(*frames(spark, [(1, long, "xx")], [(1, 1, 0)])))
    assert found["xx", "ABCDE", 1] == (1, 0, 0, 0, 0, 0, 0)
    assert found["xx", "ABCDE", 2] == (0, 1, 0, 0, 1, 0, 60)


def test_paths_through_the_lattice():
    forward, backward = filter_audit.path_counts(5)
    for state in range(32):
        size = state.bit_count()
        assert (forward[state], backward[state]) == (math.factorial(size), math.factorial(5 - size))
    assert forward[31] == backward[0] == 120


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 0, 0), ("p", 1, 2, 1, 0), ("p", 1, 1, 0, 0),
                                   ("p", 3, 4, 0, 2)],
                                  "part string, mask int, n bigint, good bigint, toxic bigint")
    found = collected(filter_audit.audit(cells, "AB"))
    assert found == {("p", "AB", 1): (5, 7, 0, 3, 1, 2, 10), ("p", "AB", 2): (5, 0, 4, 0, 0, 0, 4),
                     ("p", "BA", 1): (8, 4, 0, 0, 0, 2, 4), ("p", "BA", 2): (5, 3, 4, 3, 1, 0, 10)}
    with pytest.raises(ValueError):
        filter_audit.audit(cells, "ABCDEFGHI")

import hashlib
import re

from llm_fixtures import docs, empty  # noqa: F401
from sprout.llm import decontam
from sprout.llm.decontam import decontaminate

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))


def brute(docs, items, width=10):
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for name, text in items:
            own = words(text)
            n = min(width, len(own))
            for s in range(len(own) - n + 1 if own else 0):
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == own[s:s + n]:
                        hit.update(range(k, k + n))
                        names.add(str(name))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf"), (2, "One"),
         (3, "word word"), (4, None), (5, ""), (10, "THE QUICK, brown fox jumps over the lazy dog and"),
         (11, "no such words anywhere at all"), (2, "One"), (None, "one")]
EXTRA = [(100, "see: the quick brown fox jumps over the lazy dog and runs off; fox jumps over the lazy dog and runs away "
               "from the big"), (101, "the quick brown cat jumps over the lazy dog and runs away"), (102, "wordword word")]


def test_awkward_rows(spark, docs, empty, monkeypatch):
    items = spark.createDataFrame([(*r, "extra") for r in ITEMS], "item_id long, text string, doc_id string")
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(EXTRA, "doc_id long, text string"))
    want = brute([tuple(r) for r in rows.collect()], [r for r in ITEMS if r[0] is not None])
    got = decontaminate(rows.withColumn("n_hit", rows["doc_id"]), items).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == want
    monkeypatch.setattr(decontam, "BLOCK_TERMS", 5)  # several blocks of items
    assert sorted(map(tuple, decontaminate(rows, items).select(*COLUMNS).collect()), key=repr) == want
    assert decontaminate(empty, items).collect() == []
    clean = decontaminate(rows, items.where("false")).collect()
    assert len(clean) == rows.count() and not any(r["contaminated"] for r in clean)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha beta gamma"), (3, "alpha x x x x gamma beta")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontaminate(rows, items).collect()}
    assert got[2] == (3, 0)
    assert got[1][0] == 0 and got[1][1] > 0
    assert got[3] == (0, 0)


def test_main_path_has_no_python(spark, docs):
    from sprout.llm.exact_dedup import exact_dedup
    items = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    for df in (decontaminate(docs, items), exact_dedup(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def brute_near(docs, items, slop, width=10):
    """(doc_id, item_id, start) of windows whose two rarest terms are 1 to ``slop`` diagonals apart."""
    counts = {}
    for _, t in docs:
        for w in set(words(t)):
            counts[w] = counts.get(w, 0) + 1
    out = set()
    for name, text in items:
        own = words(text)
        for s in range(max(1, len(own) - width + 1)):
            places = range(s, min(s + width, len(own)))
            if len(places) < 2 or any(own[p] not in counts for p in places):
                continue
            p1, p2 = sorted(places, key=lambda p: (counts[own[p]], p))[:2]
            for i, t in docs:
                w = words(t)
                on = [{k - p for k in range(len(w)) if w[k] == own[p]} for p in (p1, p2)]
                both = on[0] & on[1]
                low = {min(a, b) for a in on[0] for b in on[1] if 1 <= abs(a - b) <= slop}
                out |= {(i, name, d + s) for d in low - both if d + s >= 0}
    return out


def test_proximity_over_a_diagonal_between(spark):
    """Two words inserted apart: diagonals d, d + 1 and d + 2 all have anchors of the item."""
    own = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()
    def inserted(*at):
        return " ".join(w if k not in at else f"zz {w}" for k, w in enumerate(own))
    items = [(1, " ".join(own)), (2, "alpha beta gamma")]
    rows = [(1, inserted(4, 9)), (2, inserted(2, 7)), (3, inserted(3, 6, 11)), (4, " ".join(own)),
            (5, "one two zz one four five one six seven zz eight nine ten"), (6, "alpha zz beta zz gamma")]
    rows += [(10 + k, " ".join(own[:k])) for k in range(1, 14, 3)] + [(30 + k, " ".join(own[k:])) for k in range(2, 14, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    for slop in (0, 2):
        want = brute_near(rows, items, slop)
        got = {r["doc_id"]: r["n_near"] for r in decontaminate(docs, frame, slop=slop).collect()}
        assert got == {i: len({x for x in want if x[0] == i}) for i, _ in rows}
        assert len(want) > 5 or slop < 2

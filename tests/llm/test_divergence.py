import re
from collections import Counter, defaultdict

from llm_fixtures import SF, TEXTS, docs, empty  # noqa: F401
from sprout.llm.divergence import source_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=3, top=200):
    """The definition, group by group and term by term, in Python integers."""
    n, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        groups.add((lang, source))
        n[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, k in seen[lang].items() if k >= min_docs)
        of = {s: n[lang, s] for a, s in groups if a == lang}
        whole = Counter()
        for c in of.values():
            whole.update(c)

        def shares(count):
            total = sum(count[t] for t in kept)
            return [1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept]
        p, q = {s: shares(c) for s, c in of.items()}, shares(whole)
        for s in of:
            pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p[s], p[o]))) for o in of if o != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[s], q) if of[s][t] and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


def result(df, **kw):
    out = source_divergence(df, **kw)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def test_table_whatever_the_blocks(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain([(r["lang"], r["source"], r["text"]) for r in d.collect()])
    assert result(d) == want
    assert result(d, terms=50, sources=3) == want  # many cells


def test_awkward_documents(spark, docs, empty):
    rows = [(i, t, lang, source) for k, (i, t) in enumerate(TEXTS)
            for lang, source in [(("en", None, "de")[k % 3], ("a", "b", None)[k % 2 + (k % 7 == 0)])] * 2]
    rows += [(90, "shared words here", "xx", "alone")] * 4  # one source: terms only
    rows += [(91, "once", "yy", "a"), (92, None, "yy", "b"), (93, "", "yy", "c")]  # nothing kept
    rows += [(94, "ÜBER über Straße straße", "zz", s) for s in "aabbc"] + [(95, "über", "zz", "c")] * 3
    d = spark.createDataFrame([(*r, "term", 3) for r in rows],
                              "doc_id long, text string, lang string, source string, item string, rank int")
    got = result(d)
    assert got == plain([(r[2], r[3], r[1]) for r in rows])
    assert {r[4] for r in got if r[0] == "yy"} == {0} and sum(r[0] == "yy" for r in got) == 6
    assert not any(r[0] == "xx" for r in got)  # a lang's only source has the lang's own shares
    assert result(docs.withColumn("source", docs["kept"])) == plain([("en", "kept?", t) for _, t in TEXTS])
    assert result(empty.withColumn("source", empty["kept"])) == []


def test_top_terms_and_ties(spark):
    rows = [("en", s, f"{t} {t}" if s == t[0] else t) for s in "ab" for t in (f"{c}{x}" for c in "ab" for x in "xyzuv")] * 2
    d = spark.createDataFrame(rows, "lang string, source string, text string")
    got = result(d, top_terms=3)
    assert got == plain(rows, top=3)
    assert [r[3] for r in got if r[1] == "a" and r[2] == "term"] == ["au", "av", "ax"]


def test_hot_source_is_summed_in_its_tasks(spark, monkeypatch):
    """A small table of held terms makes every task pass on several rows a term: same result."""
    import sprout.llm.divergence as module
    rows = [("en", "hot" if k % 3 else f"s{k % 5}", f"word{k % 7} common text{k % 11}") for k in range(400)]
    monkeypatch.setattr(module, "HELD", 5)
    assert result(spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)) == plain(rows)

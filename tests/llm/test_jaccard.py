import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import docs, empty  # noqa: F401
from sprout.llm import jaccard
from sprout.llm.components import components
from sprout.llm.jaccard import Shingler, jaccard_classes, jaccard_components, open_pairs, whole_parts

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LETTERS))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1))


def brute(rows, percent=90, width=3):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k
    pairs = set()
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
                if sets[a] != sets[b]:
                    pairs.add(frozenset([sets[a], sets[b]]))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(((i, len(sets[k]), least.get(top(k), i) if sets[k] else i) for k, (i, _) in enumerate(rows)),
                  key=repr), len(pairs)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near_copies(seed=1, groups=25, size=8):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    line = " ".join(rng.choices(vocab, k=12))
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randint(30, 160))
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append(" ".join(own) + " " + line * rng.randint(0, 1))
    rng.shuffle(rows)
    return [(1000 + k, t) for k, t in enumerate(rows)]


def test_awkward_rows(docs, empty):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(jaccard_components(docs)) == brute(rows)[0]
    assert jaccard_components(empty).collect() == []


def test_components_and_links_equal_brute_force(spark, monkeypatch):
    rows = near_copies()
    want, links = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(jaccard_components(df)) == want
    monkeypatch.setattr(jaccard, "BLOCK", 3)  # long lists fall into many blocks
    assert result(jaccard_components(df)) == want
    _, found, _ = jaccard_classes(df, all_links=True)
    assert found.select("a", "b").distinct().count() == found.count() == links


def test_shingler_counts_like_sets():
    shingle = Shingler()
    for text in ["", " \n", "one", "One two", "a b c", "a b c a b c", "A  b\x0bc\td é ß\x85x", "x " * 500]:
        own = shingle(text)
        assert len(own) == len(shingles(text)) and (np.diff(own.astype(object)) > 0).all()
    assert (shingle("A b") == shingle("a B")).all() and (shingle("a b") != shingle("b a")).all()


def arrays(rows):
    """Entries (t, bi, bj, n, pos, root, block, c, far) as the search gets them."""
    rows = sorted(rows, key=lambda r: (*r[:4], r[7]))
    return {c: np.array([r[k] for r in rows], np.float64 if c == "far" else np.int64)
            for k, c in enumerate(("t", "bi", "bj", "n", "pos", "root", "block", "c", "far"))}


@pytest.mark.parametrize("probes", [1, 40, 1 << 14])
@pytest.mark.parametrize("percent", [80, 90])
def test_open_pairs_are_all_that_the_bounds_allow(monkeypatch, probes, percent):
    """Skip blocks pass over nothing: every pair is tried in turn here, in lists, parts of lists and with distances."""
    monkeypatch.setattr(jaccard, "PROBES", probes)
    rng = random.Random(2)
    rows = []
    for t, bi, bj, size in ((7, 0, 0, 45), (9, 0, 0, 45), (9, 0, 1, 60), (11, 2, 2, 1), (12, 0, 0, 2), (13, 0, 3, 90)):
        for _ in range(size):
            rows.append((t, bi, bj, rng.randint(50, 80), rng.randint(0, 12), rng.randrange(9), rng.choice((bi, bj)),
                         1000 * t + len(rows), rng.choice((float("nan"), rng.random() / 3))))
    for within in (False, True):
        got = [(a, b) for x, y in open_pairs(arrays(rows), percent, within) for a, b in zip(x.tolist(), y.tolist())]
        want = set()
        for k, a in enumerate(rows):
            for b in rows[:k]:
                room = min(a[3] - a[4], b[3] - b[4])
                may = (a[:3] == b[:3] and 100 * min(a[3], b[3]) >= percent * max(a[3], b[3])
                       and (100 + percent) * room >= percent * (a[3] + b[3]) and (within or a[5] != b[5])
                       and (a[1] == a[2] or a[6] != b[6]) and not abs(a[8] - b[8]) > 1 - percent / 100 + 1e-9)
                if may:
                    want.add((min(a[7], b[7]), max(a[7], b[7])))
        assert len(got) == len(set(got)) and set(got) == want and want


def test_open_pairs_of_nothing():
    assert list(open_pairs(arrays([]), 90, False)) == []


def test_a_full_list_is_searched_in_bounded_slices():
    """4,096 equal sizes: eight million pairs, of which a slice is held at one time."""
    rows = [(1, 0, 0, 60, 0, k, 0, k, float("nan")) for k in range(4096)]
    most = total = 0
    for x, _ in open_pairs(arrays(rows), 90, False):
        most, total = max(most, len(x)), total + len(x)
    assert total == 4096 * 4095 // 2 and most <= jaccard.PROBES * jaccard.SKIP


def test_parity_differs_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(4)
    for size in (0, 1, 50, 3000):
        one = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        other = np.unique(np.concatenate([one[: size // 2], rng.integers(0, 2**63, size // 3, dtype=np.uint64)]))
        differ = sum(int(x).bit_count() for x in
                     (jaccard.parity_bits(one) ^ jaccard.parity_bits(other)).view(np.uint64))
        assert differ <= len(np.setxor1d(one, other))


def test_whole_parts_end_with_a_part():
    rows = [(t, 0, 0, 50, 0, 0, 0, k, 0.5) for t in range(30) for k in range(t % 7 + 1)]
    names = jaccard.COLUMNS
    for size in (1, 5, 1000):
        batches = [pa.RecordBatch.from_pydict({c: [r[("t", "bi", "bj", "n", "pos", "root", "block", "c", "far").index(c)]
                                                   for r in rows[k:k + 4]] for c in names}) for k in range(0, len(rows), 4)]
        got = list(whole_parts(batches, size))
        assert np.concatenate([g["t"] for g in got]).tolist() == [r[0] for r in rows]
        seen = [set(g["t"].tolist()) for g in got]
        assert all(not (a & b) for a, b in zip(seen, seen[1:]))


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_shingle_filter(spark, monkeypatch):
    rng = np.random.default_rng(5)
    own = np.unique(rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64))
    table = spark.createDataFrame([(int(x),) for x in own.view(np.int64)], "t long").repartition(3)
    found = jaccard.shingle_filter(table)
    assert found(own).all()  # never drops a shared shingle
    assert found(rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64)).mean() < 0.1
    assert not jaccard.shingle_filter(table.where("false"))(own).any()
    monkeypatch.setattr(jaccard, "FILTER_BITS", 17)
    assert jaccard.shingle_filter(table) is None


@pytest.mark.parametrize("bits", [0, 27])
def test_filter_changes_no_result(spark, monkeypatch, bits):
    monkeypatch.setattr(jaccard, "FILTER_BITS", bits)
    rows = near_copies(groups=6) + [(900, None), (901, ""), (902, "two words")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 80, 5)
    assert result(got) == brute(rows, 80, 5)[0]

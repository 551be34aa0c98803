import random
import zlib

import numpy as np
import pytest
from llm_fixtures import SF, TEXTS, docs, empty  # noqa: F401
from pyspark.sql import functions as F
from sprout.llm import simhash
from sprout.llm.simhash import RADIUS, bucket_forest, covering_masks, fingerprint, mask_tree, near_links, simhash_components

SPACE = " \t\n\x0b\x0c\r"


def plain_fingerprint(text: str | None, width: int = 3) -> int:
    """The definition, shingle by shingle and bit by bit."""
    import xxhash
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in SPACE else c for c in lower).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], radius: int) -> list[int]:
    """Index of the first fingerprint reachable from each one."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(fps))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps, RADIUS)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    return sorted((str(i), f"{f:016x}", str(least[r])) for (i, _), f, r in zip(rows, fps, roots, strict=True))


def result(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash_components(df).collect())


def test_awkward_documents(docs, empty):
    assert result(docs) == expected(TEXTS)
    assert simhash_components(empty).collect() == []
    assert [f.dataType.simpleString() for f in simhash_components(empty).schema] == ["bigint", "string", "bigint"]


def test_table_against_brute_force(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert result(d) == expected([tuple(r) for r in d.collect()])


def test_hash_is_sparks_own(spark):
    grams = ["a b c", "", "héllo wörld ß", "x" * 100]
    import xxhash
    got = spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g")).collect()
    assert [r[0] & (1 << 64) - 1 for r in got] == [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(str(zlib.crc32(str(k).encode()) % 5000) for k in range(3000))
    whole = fingerprint(text.encode())
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text.encode()) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("level", range(3))
def test_masks_cover_every_difference(level):
    """Any three positions that a path leaves free are left free by one of its masks together."""
    rng = random.Random(level)
    by_path = {}
    for path, _, mask in mask_tree()[level]:
        by_path.setdefault(path, []).append(mask)
    for masks in rng.sample(sorted(by_path.values()), min(20, len(by_path))):
        common = masks[0]
        for m in masks:
            common &= m
        free = [b for b in range(64) if not common >> b & 1]
        for _ in range(300):
            off = sum(1 << b for b in rng.sample(free, min(3, len(free))))
            assert any(m & off == 0 for m in masks)


def test_last_level_bounds_a_bucket():
    assert all(64 - mask.bit_count() <= 8 for _, _, mask in mask_tree()[-1])
    assert len(covering_masks(list(range(64)))) == 15


def test_forest_spans_its_links():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 8, 200).astype(np.uint64)
    fp = np.unique(fp ^ (np.uint64(1) << np.uint64(63)))
    a, b = bucket_forest(np.zeros(len(fp), np.int64), fp.view(np.int64), 1)
    assert len(a) < len(fp)
    roots = plain_components([int(x) for x in fp], 1)
    own = {int(x): int(y) for x, y in zip(a.view(np.uint64), b.view(np.uint64), strict=True)}
    assert len({own.get(int(x), int(x)) for x in fp}) == len(set(roots))


def test_full_buckets_lose_no_link(spark):
    """A ball of near fingerprints, far over the bucket limit, and a chain: same components as brute force."""
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = {center}
    while len(fps) < 260:
        fps.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.choice([2, 3, 5]))))
    far = rng.getrandbits(64)
    for k in range(0, 60, 3):
        far ^= 0b111 << k
        fps.add(far)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    from sprout.llm.components import components
    for limit in (4, 128):
        got = {r["node"]: r["root"] for r in components(near_links(nodes, limit=limit), "a", "b").collect()}
        roots = plain_components(fps, RADIUS)
        assert len({got.get(simhash.signed(f), simhash.signed(f)) for f in fps}) == len(set(roots))
        for i, r in enumerate(roots):
            own = [got.get(simhash.signed(fps[k]), simhash.signed(fps[k])) for k in (i, r)]
            assert own[0] == own[1]

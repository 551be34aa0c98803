import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from llm_fixtures import SF, docs, empty  # noqa: F401
from sprout.llm.common import with_row_key

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_stages_keep_columns_and_filter(spark, docs, empty, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "n-gram jaccard join", "benchmark decontamination",
                     "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, empty, SF).collect() == []
    kept = corpus_pipeline.dedup_stage(spark, docs, SF).collect()
    texts = ["".join(c for c in (r["text"] or "") if c not in " \t\n\x0b\x0c\r") for r in kept]
    assert len(texts) == len(set(texts))
    assert len(set(texts)) == len({"".join(c for c in (r["text"] or "") if c not in " \t\n\x0b\x0c\r")
                                   for r in docs.collect()})
    near = corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in near if r["doc_id"] in (1, 2, 3, 7, 8)) == [1, 7]
    assert sum(not (r["text"] or "").strip() for r in near) == 3  # linked with nothing
    assert sum(r["text"] == "repeated row" for r in near) == 1


def test_row_key_keeps_a_column_of_its_name(spark, docs):
    """A caller's own _row column comes through a stage as it was."""
    own = docs.withColumn("_row", docs["size"] + 70).withColumn("_ROW_", docs["lang"])
    rows, key = with_row_key(own)
    assert key.lower() not in {c.lower() for c in own.columns} and rows.select(key).distinct().count() == rows.count()
    kept = corpus_pipeline.dedup_stage(spark, own, SF)
    assert kept.columns == own.columns and {r["_row"] for r in kept.collect()} == {77}


def test_row_key_of_repeated_ids(docs):
    rows, key = with_row_key(docs)
    assert key == "_row" and rows.select(key).distinct().count() == rows.count()
    rows, key = with_row_key(docs.where("doc_id < 10"))
    assert key == "doc_id"


def planted(spark, folder):
    """The small tables with planted rows: (documents rows, benchmark rows, labels) written to ``folder``."""
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark", "labels")}
    rows = [tuple(r) for r in tables["documents"].select("doc_id", "text", "lang", "source", "n_chars").collect()]
    long = sorted((r for r in rows if 150 <= len((r[1] or "").split()) <= 500))[:12]
    passage = next(r["text"] for r in tables["benchmark"].collect() if len((r["text"] or "").split()) >= 15)
    extra = []
    for k, (i, text, lang, source, n) in enumerate(long):
        w = text.split()
        near = list(w)
        near[len(w) // 2] = "changed"
        for text in ("  ".join(w) + "\n", " ".join(near), " ".join(w[:40] + passage.split() + w[40:])):
            extra.append((100_000 + len(extra), text, lang, source, len(text)))
    extra += [(200_000, None, "en", "src1", 0), (200_001, " \n", "en", "src1", 2), (200_002, "$$$ !!! ### " * 60, "en", "src1", 720)]
    kept = tables["documents"].select("doc_id", "text", "lang", "source", "n_chars")
    kept.unionByName(spark.createDataFrame(extra, kept.schema)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for t in ("benchmark", "labels"):
        tables[t].write.parquet(f"{folder}/{t}.parquet")
    return ([r[:2] for r in rows + extra], [(r["item_id"], r["text"]) for r in tables["benchmark"].collect()],
            {r["doc_id"]: r["quality"] for r in tables["labels"].collect() if r["quality"] is not None})


def test_run_against_brute_force(spark, tmp_path):
    """Every stage's ids and the packed pieces, against plain restatements of the five operators."""
    from tokenizers import Tokenizer
    from test_classifiers import plain_quality
    from test_decontam import words
    from test_jaccard import shingles
    folder = str(tmp_path)
    docs, items, labels = planted(spark, folder)
    score = plain_quality(docs, labels)
    left = [(i, t) for i, t in docs if score[i][1] == 1]
    want = [sorted(i for i, _ in left)]
    groups = {}
    for i, t in left:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i))
    stays = {min(g)[1] for g in groups.values()}
    left = [(i, t) for i, t in left if i in stays]
    want.append(sorted(i for i, _ in left))
    sets = {i: shingles(t, 5) for i, t in left}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    left = [(i, t) for i, t in left if top(i) == i]
    want.append(sorted(i for i, _ in left))
    windows = set()
    for _, t in items:
        w = words(t)
        if w:
            n = min(10, len(w))
            windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    sizes = {len(w) for w in windows}

    def leaks(t):
        w = words(t)
        return any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    left = [(i, t) for i, t in left if not leaks(t)]
    want.append(sorted(i for i, _ in left))

    kept, got = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder).persist()
        got.append(sorted(r["doc_id"] for r in kept.collect()))
    assert got == want
    assert len(docs) > len(want[0]) > len(want[1]) > len(want[2]) > len(want[3]) > 0

    library, pieces = Tokenizer.from_file(PATH), []
    for i, t in left:
        own = library.encode(t or "", add_special_tokens=False).ids + [2]
        at, n = 0, len(own) % 1024 or 1024
        while at < len(own):
            raw = np.array(own[at:at + n], "<u4").tobytes()
            pieces.append((i, len([p for p in pieces if p[0] == i]), at, n, zlib.crc32(raw)))
            at, n = at + n, 1024
    out = corpus_pipeline.run(spark, folder).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out[columns].itertuples(index=False))) == sorted(pieces)
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 1024


def test_near_duplicates_between_the_bars(spark):
    """5 words and 0.8: copies that 3 words and 0.9 would leave in go, those below 0.8 stay."""
    from test_jaccard import shingles
    rows, parts = [], []
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(270)]
        for changed in (0, 5, 9):
            own = list(base)
            for k in range(changed):
                own[10 + 28 * k] = f"g{g}new{k}"
            rows.append((100 * g + changed, " ".join(own)))
    def jaccard(a, b, width):
        a, b = shingles(a, width), shingles(b, width)
        return len(a & b) / len(a | b)
    for k in range(0, len(rows), 3):
        base, near, far = (t for _, t in rows[k:k + 3])
        assert jaccard(base, near, 5) >= 0.8 and jaccard(base, near, 3) < 0.9
        assert jaccard(base, far, 5) < 0.8 and jaccard(near, far, 5) >= 0.8
        parts.append(rows[k][0])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    def kept(d):
        return sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, d, SF).collect())
    assert kept(df.where("doc_id % 100 != 9")) == parts
    assert kept(df.where("doc_id % 100 != 5")) == sorted(i for i, _ in rows if i % 100 != 5)
    assert kept(df) == parts  # linked through the copy between them

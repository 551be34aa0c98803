"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

One pass turns each text into a short vector: densities of a hand-written
lexicon and of words learnt from the labels, insults near a second person,
capitals, punctuation and obfuscated spellings. The trees are fitted on part
of the labelled rows, the calibration on the rest. ``max_train_rows`` bounds
the labelled rows used, chosen by the hash of their id.

The score is the calibrated probability, with a thousandth of the trees' own
probability mixed in so that equal steps of the calibration keep their order.

Defined cases: NULL and empty texts have a zero vector and get its score;
several labels of one id count as their largest; with labels of one value
only, that value is the score, without any it is 0; repeated rows get equal
scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from math import log1p

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, per_row, stored, text_or_empty
from .ftrl import labelled

MAX_TRAIN_ROWS = 40_000
TREES, DEPTH = 20, 4
THRESHOLD = 0.3
NEAR = 5  # words between an insult and a second person
LEARNT = 100  # words learnt from the labels, at most
LEARNT_LEAST, LEARNT_PRECISION = 10, 0.8

# Insults and slurs of low severity, and second-person words.
LEXICON = frozenset("""
abfall arsch arschloch bastard blöd bollocks cabrón clown clowns connard connasse crap cretin crétin
damn depp dirtbag disgusting dumb dumbass dumm dummkopf dégoûtant estúpido fool fools garbage
gilipollas hate hateful idiot idiota idiote idioten idiots imbecile imbécil imbécile jerk kill
liar loser losers lächerlich maldito mierda miststück moron morons müll nutzlos pathetic pathétique
pathético pendejo pig pigs putain repugnante ridicule ridículo salaud salope scheisse scheiße scum
shut stupid stupide stupidity sucks terrible tonto trash ugly useless versager vermin widerlich
worthless wretch
""".split())
SECOND_PERSON = frozenset("""
you your yours yourself yourselves youre u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes
vous votre vos tú ti tus vosotros usted ustedes
""".split())
# Letters that look-alike characters stand for.
LOOK_ALIKE = str.maketrans("013457@$!|", "oieastasil")

WORD = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
MARKS = re.compile(r"[^\w\s]+")
EDGE = ".,;:!?()[]{}\"'|*#$%&-"
FEATURES = 14


def features(text: str, learnt: frozenset = frozenset()) -> list[float]:
    """The dense vector of a text; all densities are per word or per character."""
    if not text or text.isspace():
        return [0.0] * FEATURES
    found = WORD.findall(text)
    low = [w.lower() for w in found]
    n, chars = max(1, len(found)), len(text)
    hits = [k for k, w in enumerate(low) if w in LEXICON]
    taught = [w for w in low if w in learnt]
    you = [k for k, w in enumerate(low) if w in SECOND_PERSON]
    near, at = 0, 0
    for k in hits:
        while at < len(you) and you[at] < k - NEAR:
            at += 1
        near += at < len(you) and you[at] <= k + NEAR
    shouted = sum(len(w) > 1 and w.isupper() for w in found)
    capitals = sum(map(len, CAPITALS.findall(text)))
    # Spellings such as "1d!ot": something other than letters between letters.
    odd = [w for w in (t.strip(EDGE) for t in text.split()) if not w.isalpha() and WORD.search(w)]
    plain = ["".join(WORD.findall(w.lower().translate(LOOK_ALIKE))) for w in odd]
    hidden = sum(p in LEXICON or p in learnt for p in plain)
    marks = sum(map(len, MARKS.findall(text)))
    return [len(hits) / n, log1p(len(hits)), float(len({low[k] for k in hits})), len(taught) / n, log1p(len(taught)),
            len(you) / n, near / n, capitals / chars, shouted / n, marks / chars, text.count("!") / chars,
            len(odd) / n, hidden / n, log1p(n)]


def for_calibration(doc_id: str) -> Column:
    """One labelled id in five."""
    return F.pmod(F.xxhash64(doc_id, F.lit("calibrate")), F.lit(5)) == 0


def learnt_words(rows: DataFrame) -> frozenset:
    """Words of toxic training texts that others hardly use, at most ``LEARNT``.

    Equal texts count once, so a group of copies teaches nothing.
    """
    once = rows.select(F.xxhash64("text").alias("h"), "text", "label").dropDuplicates(["h"])
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0))
    counts = (once.select("label", F.explode(tokens).alias("w")).groupBy("w")
              .agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n"))
              .where((F.col("p") >= LEARNT_LEAST) & (F.col("p") >= LEARNT_PRECISION * F.col("n"))))
    return frozenset(r["w"] for r in counts.orderBy(F.desc("p"), "w").limit(LEARNT).collect())


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS,
                    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    # Nothing is learnt from the rows of the calibration, words neither.
    known = labelled(docs, labels, label, max_train_rows, doc_id, text)
    learnt = learnt_words(known.where(~for_calibration("doc_id")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        return lambda key, raw: (key, features(raw, learnt))

    vectors = stored(per_row(rows, make, f"doc_id {kind}, dense array<double>"), "toxicity_features")
    vectors = vectors.withColumn("features", array_to_vector("dense"))
    train = stored(labelled(vectors.withColumn("text", F.lit("")), labels, label, max_train_rows)
                   .select("doc_id", "label").distinct(), "toxicity_labels")
    train = vectors.join(F.broadcast(train), "doc_id").select("doc_id", "features", F.col("label").cast("double"))
    values = train.groupBy("label").count().collect()
    if len(values) < 2:
        return scored(vectors.withColumn("score", F.lit(values[0]["label"] if values else 0.0)), threshold)

    calibrate = for_calibration("doc_id")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, subsamplingRate=0.9, seed=7,
                          minInstancesPerNode=5).fit(train.where(~calibrate).select("features", "label"))
    own = vector_to_array("probability").getItem(1)
    kept_out = trees.transform(train.where(calibrate)).select(own.alias("raw"), "label")
    steps = IsotonicRegression(featuresCol="raw", predictionCol="step").fit(kept_out) \
        if kept_out.limit(1).count() else None
    out = trees.transform(vectors.select("doc_id", "features")).select("doc_id", own.alias("raw"))
    if steps is None:
        return scored(out.withColumn("score", F.col("raw")), threshold)
    mixed = 0.999 * F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("step"))) + 0.001 * F.col("raw")
    return scored(steps.transform(out).withColumn("score", mixed), threshold)


def scored(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))

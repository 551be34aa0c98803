"""DuckDB SQL statements of the oracle-checked queries.

Written independently of the DataFrame code, from the same specification:
tokens via ``regexp_extract_all``, N-gram windows via ``unnest ... WITH
ORDINALITY`` and ``lead``, training unrolled as three epochs of CTEs.
Column names, types and rounding match :mod:`sprout.queries`.
"""

from __future__ import annotations

from .queries import CHECK, KEYWORD, ROUND2, SEARCH_ROUND1_GRID, SENSE_NEG, SENSE_POS

TOKEN_RE = "[a-z]+(?:''[a-z]+)?"
WORD_RE = "[A-Za-z]+(?:''[A-Za-z]+)?"

SENTENCES = """
sentences AS MATERIALIZED (
  SELECT d.doc_id AS sent_id, d.text,
         CAST(CASE WHEN l.quality = 1 THEN 1 WHEN l.quality = 0 THEN -1 ELSE 0 END AS INTEGER) AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
train AS MATERIALIZED (SELECT * FROM sentences WHERE NOT (label <> 0 AND sent_id % 5 = 0)),
test AS MATERIALIZED (SELECT * FROM sentences WHERE label <> 0 AND sent_id % 5 = 0)"""


def _ngram_cte(name: str, source: str, n: int, keys: str = "sent_id, label") -> str:
    """``name`` (keys..., ngram, pos) for every N-gram occurrence of ``source``."""
    tok = (f"{name}_tok AS MATERIALIZED (SELECT {keys}, t.tok, t.pos FROM {source}, "
           f"unnest(regexp_extract_all(lower(text), '{TOKEN_RE}')) WITH ORDINALITY AS t(tok, pos))")
    if n == 1:
        return tok + f",\n{name} AS (SELECT {keys}, tok AS ngram, pos FROM {name}_tok)"
    part = ", ".join(f"lead(tok, {k}) OVER w AS t{k}" for k in range(1, n))
    joined = " || ' ' || ".join(["tok"] + [f"t{k}" for k in range(1, n)])
    part_keys = keys
    return (tok + f",\n{name}_win AS (SELECT {keys}, pos, tok, {part} FROM {name}_tok "
            f"WINDOW w AS (PARTITION BY {part_keys} ORDER BY pos)),\n"
            f"{name} AS (SELECT {keys}, {joined} AS ngram, pos FROM {name}_win WHERE t{n - 1} IS NOT NULL)")


def _ig_expr() -> str:
    p1, n1 = "CAST(pos AS DOUBLE)", "CAST(neg AS DOUBLE)"
    p2, n2 = "CAST(tot_p - pos AS DOUBLE)", "CAST(tot_q - neg AS DOUBLE)"
    w1 = f"(({p1} + {n1}) / CAST(tot_p + tot_q AS DOUBLE))"
    a = f"({p1} / ({p1} + {n1}))"
    b = f"({p2} / ({p2} + {n2}))"

    def xl(x, y):
        return f"({x} * log10({y}) / log10(2.0))"

    left = f"({xl(a, a)} + {xl(f'(1.0 - {a})', f'(1.0 - {a})')})"
    right = f"({xl(a, b)} + {xl(f'(1.0 - {b})', f'(1.0 - {b})')})"
    expr = f"({w1} * {left} + (1.0 - {w1}) * {right})"
    return (f"round(CASE WHEN pos > 0 AND neg > 0 AND tot_p - pos > 0 AND tot_q - neg > 0 "
            f"THEN {expr} END, 9)")


def _vocab_ctes(n: int, m: int, pfx: str = "", train: str = "train") -> str:
    """{pfx}train_ng, {pfx}totals, {pfx}class_counts, {pfx}gains, {pfx}vocab over ``train``."""
    return f""",
{_ngram_cte(pfx + 'train_ng', train, n)},
{pfx}totals AS (SELECT count(*) FILTER (WHERE label = 1) AS tot_p, count(*) FILTER (WHERE label = -1) AS tot_q FROM {train}),
{pfx}class_counts AS (
  SELECT ngram, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = -1) AS neg
  FROM (SELECT DISTINCT sent_id, label, ngram FROM {pfx}train_ng WHERE label <> 0) GROUP BY ngram),
{pfx}gains AS (SELECT ngram, pos, neg, {_ig_expr()} AS ig FROM {pfx}class_counts, {pfx}totals),
{pfx}vocab AS MATERIALIZED (
  SELECT ngram, CAST(row_number() OVER (ORDER BY ig DESC NULLS LAST, ngram) - 1 AS INTEGER) AS fid, ig, pos, neg
  FROM {pfx}gains QUALIFY row_number() OVER (ORDER BY ig DESC NULLS LAST, ngram) <= {m})"""


def _epoch(e: int, alpha: float, pfx: str = "") -> str:
    prev = f"{pfx}w{e - 1}"
    return f""",
{pfx}score{e} AS (SELECT o.sent_id, any_value(o.label) AS label, sum(coalesce(w.weight, 0.0)) AS score
            FROM {pfx}occ o LEFT JOIN {prev} w ON o.fid = w.fid GROUP BY o.sent_id),
{pfx}d{e} AS (SELECT o.fid, sum(((CASE WHEN s.label > 0 THEN 1.0 ELSE 0.0 END) - 1.0 / (1.0 + exp(-s.score))) * {alpha!r}) AS delta
        FROM {pfx}occ o JOIN {pfx}score{e} s ON o.sent_id = s.sent_id GROUP BY o.fid),
{pfx}l1_{e} AS (SELECT coalesce(sum(abs(delta)), 0.0) AS l1 FROM {pfx}d{e}),
{pfx}w{e} AS MATERIALIZED (SELECT d.fid, d.delta + coalesce(w.weight, 0.0) AS weight FROM {pfx}d{e} d LEFT JOIN {prev} w ON d.fid = w.fid)"""


def _model_ctes(p=CHECK, pfx: str = "", train: str = "train") -> str:
    """{pfx}vocab, {pfx}occ (labelled occurrences), {pfx}w1.., {pfx}model (ngram, fid, weight, n)."""
    n, m, alpha, delta = p["n"], p["m"], p["alpha"], p["delta"]
    sql = _vocab_ctes(n, m, pfx, train)
    sql += f""",
{pfx}occ AS MATERIALIZED (SELECT t.sent_id, t.label, v.fid FROM {pfx}train_ng t JOIN {pfx}vocab v ON t.ngram = v.ngram WHERE t.label <> 0),
{pfx}w0 AS (SELECT CAST(NULL AS INTEGER) AS fid, CAST(NULL AS DOUBLE) AS weight WHERE false)"""
    epochs = p["n_iter"]
    for e in range(1, epochs + 1):
        sql += _epoch(e, alpha, pfx)
    # Stop right after the first epoch whose L1 step is below delta.
    parts = []
    for e in range(1, epochs + 1):
        before = " AND ".join(f"(SELECT l1 FROM {pfx}l1_{k}) >= {delta!r}" for k in range(1, e)) or "true"
        last = f"(SELECT l1 FROM {pfx}l1_{e}) < {delta!r}" if e < epochs else "true"
        parts.append(f"SELECT fid, weight FROM {pfx}w{e} WHERE {before} AND {last}")
    sql += f",\n{pfx}wfinal AS (" + " UNION ALL ".join(parts) + ")"
    sql += f""",
{pfx}model AS MATERIALIZED (SELECT v.ngram, v.fid, coalesce(w.weight, 0.0) AS weight, CAST({n} AS INTEGER) AS n
          FROM {pfx}vocab v LEFT JOIN {pfx}wfinal w ON v.fid = w.fid)"""
    return sql


def _scores(name: str, source: str, keys: str, n: int = 1, model: str = "model") -> str:
    """``name`` (source columns..., score) for every row of ``source`` under ``model``."""
    on = " AND ".join(f"r.{k.strip()} = h.{k.strip()}" for k in keys.split(","))
    return f""",
{_ngram_cte(name + '_ng', source, n, keys)},
{name}_hits AS (SELECT {keys}, sum(m.weight) AS s FROM {name}_ng g JOIN {model} m ON g.ngram = m.ngram GROUP BY {keys}),
{name} AS (SELECT r.*, coalesce(h.s, 0.0) AS score FROM {source} r LEFT JOIN {name}_hits h ON {on})"""


def _relabel_sql(scored: str, threshold: float) -> str:
    return (f"SELECT sent_id, text, CAST(CASE WHEN label <> 0 THEN label WHEN score > {threshold!r} THEN 1 "
            f"WHEN score < -{threshold!r} THEN -1 ELSE 0 END AS INTEGER) AS label FROM {scored}")


def _self_train_round2(p=CHECK) -> str:
    """Two rounds of the loop, with its stop rule after round 1."""
    t = p["threshold"]
    ctes = (_model_ctes(p, "r1_", "train") + _scores("r1_scored", "train", "sent_id", p["n"], "r1_model")
            + f",\ntrain2 AS MATERIALIZED ({_relabel_sql('r1_scored', t)})"
            + _model_ctes(p, "r2_", "train2") + _scores("r2_scored", "train2", "sent_id", p["n"], "r2_model")
            + f",\ntrain3 AS ({_relabel_sql('r2_scored', t)})"
            + ",\nu AS (SELECT (SELECT count(*) FROM train WHERE label = 0) AS u0, "
              "(SELECT count(*) FROM train2 WHERE label = 0) AS u1)")
    return _with(ctes) + ("SELECT sent_id, label FROM train2 WHERE (SELECT u1 FROM u) = 0 OR (SELECT u1 FROM u) = (SELECT u0 FROM u)\n"
                          "UNION ALL SELECT sent_id, label FROM train3 WHERE (SELECT u1 FROM u) > 0 AND (SELECT u1 FROM u) <> (SELECT u0 FROM u)")


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def _with(*ctes: str) -> str:
    return "WITH " + SENTENCES + "".join(ctes) + "\n"


def _q_ngrams(n: int) -> str:
    return _with(",\n" + _ngram_cte("all_ng", "sentences", n, "sent_id")) + \
        "SELECT ngram, count(*) AS occurrences FROM all_ng GROUP BY ngram"


def _search_round1() -> str:
    """One SELECT per configuration (loop order: m outer, threshold inner)."""
    g = SEARCH_ROUND1_GRID
    ms = list(range(g["m"][0], g["m"][1] + 1, g["m"][2]))
    ts = [g["threshold"][0] + k * g["threshold"][2] for k in range(2)]
    parts, cid = [], 0
    for m in ms:
        p = dict(n=1, m=m, n_iter=g["num_iter"][0], alpha=g["alpha"][0], delta=g["delta"][0])
        for t in ts:
            parts.append(
                "(" + _with(_model_ctes(p), _scores("scored", "test", "sent_id")) +
                f"SELECT CAST({cid} AS INTEGER) AS config_id, CAST({m} AS INTEGER) AS m, "
                f"CAST({t!r} AS DOUBLE) AS threshold, "
                "round(avg(CASE WHEN score * label > 0 THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored)")
            cid += 1
    return "\nUNION ALL\n".join(parts)


ORACLES: dict[str, str] = {
    "scan_sentences": _with() + "SELECT regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text, label FROM sentences",
    "overwrite_outputs": _with() + "SELECT regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text, label FROM sentences",
    "line_index": _with() + (
        "SELECT row_number() OVER (ORDER BY sent_id) - 1 AS sent_id, "
        "regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text, label FROM sentences"),
    "parse_lines": _with() + "SELECT sent_id, text, label FROM sentences",
    "parse_lines_strip3": _with() + (
        "SELECT sent_id, CASE WHEN length(text) >= 2 THEN substr(text, 1, length(text) - 2) ELSE '' END AS text, "
        "label FROM sentences"),
    "encode_labelled_text": _with() + (
        "SELECT sent_id, text || CASE label WHEN 1 THEN '+' WHEN -1 THEN '-' ELSE '0' END AS value FROM sentences"),
    "label_counts": _with() + """SELECT CASE WHEN label <> 0 AND sent_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
  count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = -1) AS negatives,
  count(*) FILTER (WHERE label = 0) AS unlabelled, count(*) AS total FROM sentences GROUP BY 1""",
    "split_train_test": _with() + (
        "SELECT sent_id, label, 'train' AS split FROM train UNION ALL SELECT sent_id, label, 'test' AS split FROM test"),
    "labelled_only": _with() + "SELECT sent_id, label FROM train WHERE label <> 0",
    "tokenize": _with(",\n" + _ngram_cte("all_ng", "sentences", 1, "sent_id")) + (
        "SELECT sent_id, CAST(pos - 1 AS INTEGER) AS pos, ngram AS token FROM all_ng"),
    "ngrams_n1": _q_ngrams(1),
    "ngrams_n2": _q_ngrams(2),
    "ngrams_n3": _q_ngrams(3),
    "ngram_doc_freq": _with(",\n" + _ngram_cte("train_ng", "train", CHECK["n"])) + (
        "SELECT ngram, count(DISTINCT sent_id) AS df FROM train_ng GROUP BY ngram"),
    "ngram_class_counts": _with(_vocab_ctes(CHECK["n"], CHECK["m"])) + "SELECT ngram, pos, neg FROM class_counts",
    "info_gain": _with(_vocab_ctes(CHECK["n"], CHECK["m"])) + "SELECT ngram, pos, neg, ig FROM gains",
    "select_vocab": _with(_vocab_ctes(CHECK["n"], CHECK["m"])) + "SELECT ngram, fid, ig, pos, neg FROM vocab",
    "select_vocab_n2": _with(_vocab_ctes(2, CHECK["m"])) + "SELECT ngram, fid, ig, pos, neg FROM vocab",
    "vocab_semi_filter": _with(_vocab_ctes(CHECK["n"], CHECK["m"])) + (
        "SELECT ngram, count(*) AS occurrences FROM train_ng WHERE ngram IN (SELECT ngram FROM vocab) GROUP BY ngram"),
    "featurize": _with(_model_ctes()) + "SELECT sent_id, fid, count(*) AS cnt FROM occ GROUP BY sent_id, fid",
    "featurize_n2": _with(_model_ctes(dict(CHECK, n=2))) + (
        "SELECT sent_id, fid, count(*) AS cnt FROM occ GROUP BY sent_id, fid"),
    "gradient_step": _with(_model_ctes()) + f"SELECT fid, {r6('delta')} AS delta FROM d1",
    "gradient_norm": _with(_model_ctes()) + f"SELECT {r6('l1')} AS l1 FROM l1_1",
    "train_weights_3ep": _with(_model_ctes()) + (
        f"SELECT fid, ngram, {r6('weight')} AS weight FROM model WHERE weight <> 0"),
    "model_table": _with(_model_ctes()) + f"SELECT ngram, fid, {r6('weight')} AS weight, n FROM model",
    "model_roundtrip": _with(_model_ctes()) + (
        "SELECT ngram, CAST(row_number() OVER (ORDER BY round(weight, 12) DESC, ngram) - 1 AS INTEGER) AS fid, "
        f"{r6('weight')} AS weight, n FROM model"),
    "score_sentences": _with(_model_ctes(), _scores("scored", "test", "sent_id")) + (
        f"SELECT sent_id, label, {r6('score')} AS score FROM scored"),
    "predict_proba": _with(_model_ctes(), _scores("scored", "test", "sent_id")) + (
        f"SELECT sent_id, {r6('1.0 / (1.0 + exp(-score))')} AS prob FROM scored"),
    "threshold_label": _with(_model_ctes(), ",\nunl AS (SELECT * FROM train WHERE label = 0)",
                             _scores("scored", "unl", "sent_id")) + (
        f"SELECT sent_id, {r6('score')} AS score, CAST(CASE WHEN score > {CHECK['threshold']!r} THEN 1 "
        f"WHEN score < -{CHECK['threshold']!r} THEN -1 ELSE 0 END AS INTEGER) AS new_label FROM scored"),
    "accuracy": _with(_model_ctes(), _scores("scored", "test", "sent_id")) + (
        "SELECT round(avg(CASE WHEN score * label > 0 THEN 1.0 ELSE 0.0 END), 9) AS accuracy, count(*) AS n, "
        "CAST(coalesce(sum(CASE WHEN score * label > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS correct FROM scored"),
    "score_batch": _with(_model_ctes(), _scores("scored", "conversations", "conv_id, turn")) + (
        f"SELECT conv_id, turn, {r6('score')} AS score, CASE WHEN score > 0 THEN '+' ELSE '-' END AS label FROM scored"),
    "score_batch_joined": _with(_model_ctes(), _scores("scored", "conversations", "conv_id, turn")) + (
        f"SELECT conv_id, turn, {r6('score')} AS score, CASE WHEN score > 0 THEN '+' ELSE '-' END AS label FROM scored"),
    "self_train_round1": _with(_model_ctes(), _scores("scored", "train", "sent_id")) + (
        f"SELECT sent_id, CAST(CASE WHEN label <> 0 THEN label WHEN score > {CHECK['threshold']!r} THEN 1 "
        f"WHEN score < -{CHECK['threshold']!r} THEN -1 ELSE 0 END AS INTEGER) AS label FROM scored"),
    "self_train_round2": _self_train_round2(ROUND2),
    "selftrain_output_lines": _with(_model_ctes(), _scores("scored", "train", "sent_id"),
                                    f",\nlabelled AS ({_relabel_sql('scored', CHECK['threshold'])})") + (
        "SELECT sent_id, text || CASE label WHEN 1 THEN '+' WHEN -1 THEN '-' ELSE '0' END AS value FROM labelled"),
    "self_train_round1_n2": _with(_model_ctes(dict(CHECK, n=2)), _scores("scored", "train", "sent_id", n=2)) + (
        f"SELECT sent_id, CAST(CASE WHEN label <> 0 THEN label WHEN score > {CHECK['threshold']!r} THEN 1 "
        f"WHEN score < -{CHECK['threshold']!r} THEN -1 ELSE 0 END AS INTEGER) AS label FROM scored"),
    "search_round1": _search_round1(),
    "best_config_round1": ("SELECT config_id, m, threshold, accuracy FROM (" + _search_round1() + ")\n"
                           "ORDER BY greatest(coalesce(accuracy, 0), 0) DESC, config_id LIMIT 1"),
    "corpus_union": """SELECT 'documents' AS corpus, doc_id AS item_id, CAST(0 AS BIGINT) AS sub_id, text FROM documents
UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations
UNION ALL SELECT 'benchmark', item_id, CAST(0 AS BIGINT), text FROM benchmark""",
    "keyword_filter": f"SELECT doc_id FROM documents WHERE list_contains(regexp_extract_all(text, '{WORD_RE}'), '{KEYWORD}')",
    "seed_by_marker": (f"SELECT doc_id, CASE WHEN contains(source, '{SENSE_POS}') THEN '+' "
                       f"WHEN contains(source, '{SENSE_NEG}') THEN '-' ELSE '0' END AS marker FROM documents"),
    "build_corpus": f"""WITH docs AS (SELECT 'documents' AS corpus, doc_id AS item_id, CAST(0 AS BIGINT) AS sub_id, text,
      CASE WHEN contains(source, '{SENSE_POS}') THEN '+' WHEN contains(source, '{SENSE_NEG}') THEN '-' ELSE '0' END AS marker
    FROM documents),
conv AS (SELECT 'conversations' AS corpus, conv_id AS item_id, turn AS sub_id, text, '0' AS marker FROM conversations),
bench AS (SELECT 'benchmark' AS corpus, item_id, CAST(0 AS BIGINT) AS sub_id, text, '0' AS marker FROM benchmark),
alls AS (SELECT * FROM docs UNION ALL SELECT * FROM conv UNION ALL SELECT * FROM bench),
w AS (SELECT corpus, item_id, sub_id, text, regexp_extract_all(text, '{WORD_RE}') AS words, marker FROM alls)
SELECT corpus, item_id, sub_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') || marker AS value FROM w
WHERE list_contains(words, '{KEYWORD}')""",
}

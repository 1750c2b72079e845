"""DuckDB SQL twins of the registered queries (the correctness oracle).

Views ``documents``, ``labels``, ``conversations`` ... are registered by the
checker.  Column names and types follow the Spark side; nothing is imported from
the code under test, so fixed values are stated here again.
"""

from __future__ import annotations

from collections.abc import Sequence

# Class lists, example width, chunk length, generated length.
LANGS = ("de", "en", "es", "fr")
BINARY = ("0", "1")
SEQ_LEN = 663
CHUNK_LEN = 1000
GEN_STEPS = 300

ORACLE: dict[str, str] = {}

# --- SQL fragments mirroring lexiflow.functions ---------------------------

BLANKS = r"'[ \t\n\f\r]+'"
STRIP = r"""'[0-9.:,"''()\[\]|/?!;]'"""


def words_sql(text: str) -> str:
    """Blank-separated words, empty pieces dropped."""
    return f"list_filter(regexp_split_to_array({text}, {BLANKS}), lambda x: x <> '')"


def clean_sql(word: str) -> str:
    return f"lower(regexp_replace({word}, {STRIP}, '', 'g'))"


def tokens_sql(text: str, normalize: bool = True) -> str:
    """P01 + P02: token list of a text."""
    w = words_sql(text)
    if not normalize:
        return w
    return f"list_filter(list_transform({w}, lambda x: {clean_sql('x')}), lambda x: x <> '')"


def hash_sql(key: str, seed, modulus: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), '')), 1, 8))::UBIGINT % {modulus})"


def split_sql(key: str = "text", fraction: float = 0.7, seed: int = 11) -> str:
    return f"({hash_sql(key, seed, 100)} < {int(round(fraction * 100))})"


def label_id_sql(col: str, classes: Sequence[str]) -> str:
    lst = "[" + ", ".join(f"'{c}'" for c in classes) + "]"
    return f"CAST(coalesce(list_position({lst}, CAST({col} AS VARCHAR)), 0) - 1 AS INTEGER)"


def labelled_sql(target: str) -> str:
    if target == "lang":
        return (f"SELECT doc_id, text, {label_id_sql('lang', LANGS)} AS label_id FROM documents")
    return (f"SELECT d.doc_id, d.text, {label_id_sql('l.' + target, BINARY)} AS label_id "
            f"FROM documents d JOIN labels l ON d.doc_id = l.doc_id")


def counted_sql(target: str, reduction: str = "mean") -> str:
    """CTEs ending in ``pred(doc_id, label_id, class_id, mean_score)``."""
    classes = LANGS if target == "lang" else BINARY
    k, names = len(classes), "[" + ", ".join(f"'{c}'" for c in classes) + "]"
    per_class = ", ".join(f"sum(CASE WHEN label_id = {c} THEN 1 ELSE 0 END) AS n{c}" for c in range(k))
    scores = ", ".join(
        f"(coalesce(m.n{c}, 0) + 1)::DOUBLE / (coalesce(m.n_word, 0) + {k}) AS s{c}" for c in range(k))
    if reduction == "mean":
        red = ", ".join(f"round(sum(s{c}) / count(*), 6) AS m{c}" for c in range(k))
        test_tok = "SELECT doc_id, label_id, pos, word FROM tok WHERE NOT is_train"
    else:
        red = ", ".join(f"round(max_by(s{c}, pos), 6) AS m{c}" for c in range(k))
        test_tok = ("SELECT doc_id, label_id, pos, word FROM (SELECT *, max(pos) OVER "
                    "(PARTITION BY doc_id) AS mp FROM tok WHERE NOT is_train) WHERE pos = mp")
    mlist = ", ".join(f"m{c}" for c in range(k))
    return f"""
lab AS (SELECT * FROM ({labelled_sql(target)}) WHERE label_id BETWEEN 0 AND {k - 1}),
sp AS (SELECT doc_id, label_id, {tokens_sql('text')} AS toks,
              {split_sql('text')} AS is_train FROM lab),
tok AS (SELECT doc_id, label_id, is_train, CAST(unnest(range(len(toks))) AS INTEGER) AS pos,
               unnest(toks) AS word FROM sp),
model AS (SELECT word, count(*) AS n_word, {per_class} FROM tok WHERE is_train GROUP BY word),
test_tok AS ({test_tok}),
steps AS (SELECT t.doc_id, t.label_id, t.pos, {scores}
          FROM test_tok t LEFT JOIN model m ON t.word = m.word),
red AS (SELECT doc_id, label_id, {red} FROM steps GROUP BY doc_id, label_id),
longf AS (SELECT doc_id, label_id, CAST(unnest(range({k})) AS INTEGER) AS class_id,
                 unnest([{mlist}]) AS score FROM red),
pred AS (SELECT doc_id, label_id, class_id, score AS mean_score, {names}[class_id + 1] AS label FROM (
           SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class_id) AS rn
           FROM longf) WHERE rn = 1)"""


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


register("predict_lang", f"WITH {counted_sql('lang')} SELECT * FROM pred")
register("predict_quality", f"WITH {counted_sql('quality')} SELECT * FROM pred")
register("predict_toxic", f"WITH {counted_sql('toxic')} SELECT * FROM pred")
register("predict_rejected", f"""
SELECT doc_id, reason FROM (
  SELECT d.doc_id, CASE WHEN len({tokens_sql("coalesce(d.text, '')")}) = 0 THEN 'empty'
                        WHEN l.quality IS NULL OR l.quality NOT IN (0, 1) THEN 'unknown_label' END AS reason
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE NOT {split_sql('d.text')})
WHERE reason IS NOT NULL""")
register("accuracy_counted", f"""WITH {counted_sql('lang')}
SELECT count(*) AS n_test, CAST(sum(CASE WHEN label_id = class_id THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(sum(CASE WHEN label_id = class_id THEN 1 ELSE 0 END) / count(*), 6) AS accuracy FROM pred""")
register("confusion_counted", f"""WITH {counted_sql('lang')}
SELECT label_id, class_id AS pred_id, count(*) AS n FROM pred GROUP BY 1, 2""")
register("predict_repeated_keys", f"""WITH {counted_sql('lang')}
SELECT CASE WHEN d.source <> 'src0' THEN d.source END AS source_key, p.label_id, p.class_id, p.mean_score, p.label
FROM pred p JOIN documents d ON p.doc_id = d.doc_id""")
register("last_step_predict", f"WITH {counted_sql('quality', 'last_step')} SELECT * FROM pred")


# ---------------------------------------------------------------- step 2 ---

STOP_WORDS = ("the", "and", "of", "de", "la", "le", "el", "der", "die", "und")


def doc_tok_sql(table: str = "documents", key: str = "doc_id", keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return (f"SELECT {key}, {k}CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS word "
            f"FROM (SELECT {key}, {k}{tokens_sql('text')} AS toks FROM {table})")


VOCAB_CTE = f"""dtok AS ({doc_tok_sql()}),
counts AS (SELECT word, count(*) AS freq FROM dtok GROUP BY word),
vocab AS (SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) - 1 AS idx FROM counts)"""

register("tokens_clean", doc_tok_sql())
register("word_counts", f"SELECT word, count(*) AS freq FROM ({doc_tok_sql()}) GROUP BY word")
register("min_count_words",
         f"SELECT word, count(*) AS freq FROM ({doc_tok_sql()}) GROUP BY word HAVING count(*) >= 2")
register("token_total", f"SELECT count(*) AS token_total FROM ({doc_tok_sql()})")
register("vocab_size", f"SELECT count(DISTINCT word) AS vocab_size FROM ({doc_tok_sql()})")
_LANG_TOK = doc_tok_sql("documents", "doc_id", "lang, source")
register("vocab_sizes_approx", " UNION ALL ".join(f"""
SELECT '{by}' AS level, {'lang' if 'lang' in by else 'NULL::VARCHAR'} AS lang, {'source' if 'source' in by else 'NULL::VARCHAR'} AS source,
       count(DISTINCT word) AS vocab_size, count(*) AS n_tokens, true AS near
FROM ({_LANG_TOK}) {'GROUP BY ' + by if by else ''}""" for by in ("lang, source", "lang", "source", "")))
register("vocab_index", f"WITH {VOCAB_CTE} SELECT word, freq, idx FROM vocab")
_stop = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
register("stop_words_removed", f"""
SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS word
FROM (SELECT doc_id, list_filter({tokens_sql('text')}, lambda x: NOT list_contains({_stop}, x)) AS toks
      FROM documents)""")
register("word_bigrams", f"""
SELECT doc_id, CAST(unnest(range(greatest(len(toks) - 1, 0))) AS INTEGER) AS pos,
       unnest(list_transform(range(greatest(len(toks) - 1, 0)),
                             lambda i: toks[i + 1] || ' ' || toks[i + 2])) AS ngram
FROM (SELECT doc_id, {tokens_sql('text')} AS toks FROM documents)""")
register("configured_vocab", f"""
WITH kept AS (SELECT list_filter({tokens_sql('text')}, lambda x: NOT list_contains({_stop}, x)) AS toks FROM documents),
pairs AS (SELECT unnest(list_transform(range(greatest(len(toks) - 1, 0)),
                                       lambda i: toks[i + 1] || ' ' || toks[i + 2])) AS word FROM kept),
counts AS (SELECT word, count(*) AS freq FROM pairs GROUP BY word HAVING count(*) >= 2)
SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word) - 1 AS idx FROM counts""")
register("joined_tokens", f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS joined FROM documents")
CONV_TOK = doc_tok_sql("conversations", "conv_id", "turn")
register("lookup_default", f"""WITH {VOCAB_CTE}, ctok AS ({CONV_TOK})
SELECT c.conv_id, c.turn, c.pos, c.word, coalesce(v.idx, 0) AS idx,
       CAST(v.idx IS NOT NULL AS INTEGER) AS known
FROM ctok c LEFT JOIN vocab v ON c.word = v.word""")
register("unknown_words", f"""WITH {VOCAB_CTE}, ctok AS ({CONV_TOK})
SELECT word, count(*) AS n FROM ctok WHERE word NOT IN (SELECT word FROM vocab) GROUP BY word""")


# ---------------------------------------------------------------- step 3 ---

LINE_CLASSES = ("de", "en")
_lines = f"""parts AS (
  SELECT doc_id, w[1] AS label, w[2:] AS rest, len(w) AS n,
         {label_id_sql('w[1]', LINE_CLASSES)} AS label_id
  FROM (SELECT doc_id, {words_sql("concat_ws(' ', lang, text)")} AS w FROM documents)),
tagged AS (SELECT *, CASE WHEN n = 0 THEN 'empty' WHEN label_id < 0 THEN 'unknown_label'
                          WHEN n = 1 THEN 'label_only' END AS reason FROM parts)"""
register("split_label", f"""WITH {_lines}
SELECT doc_id, label, label_id,
       CASE WHEN label_id >= 0 AND label_id < 2 THEN ['de', 'en'][label_id + 1] END AS label_name,
       array_to_string(rest, ' ') AS text
FROM tagged WHERE reason IS NULL""")
register("split_rejected", f"WITH {_lines} SELECT doc_id, reason FROM tagged WHERE reason IS NOT NULL")


def examples_sql(source: str, with_label: bool, seq_len: int = SEQ_LEN) -> str:
    """CTEs ending in ``ex(doc_id, [label_id,] n_tokens, ids, known)``."""
    lab = "label_id, " if with_label else ""
    return f"""{VOCAB_CTE},
src AS ({source}),
tk AS (SELECT doc_id, {lab}n_tokens, CAST(unnest(range(len(toks))) AS INTEGER) AS pos,
              unnest(toks) AS word
       FROM (SELECT doc_id, {lab}CAST(len(t) AS INTEGER) AS n_tokens, t[1:{seq_len}] AS toks
             FROM (SELECT doc_id, {lab}{tokens_sql('text')} AS t FROM src))),
ex AS (SELECT tk.doc_id, {'tk.label_id, ' if with_label else ''}tk.n_tokens,
              list(coalesce(v.idx, 0) ORDER BY tk.pos) AS ids,
              list(CAST(v.idx IS NOT NULL AS INTEGER) ORDER BY tk.pos) AS known
       FROM tk LEFT JOIN vocab v ON tk.word = v.word
       GROUP BY ALL)"""


def _mask_sql(seq_len: int = SEQ_LEN) -> str:
    return f"list_transform(range({seq_len}), lambda i: CAST(i < least(n_tokens, {seq_len}) AS INTEGER))"


register("encoded_padded", f"""WITH {examples_sql('SELECT doc_id, text FROM documents', False)}
SELECT doc_id, n_tokens, n_tokens > {SEQ_LEN} AS truncated,
       array_to_string(list_concat(ids, CAST(repeat([0], {SEQ_LEN} - len(ids)) AS BIGINT[])), ',') AS features,
       array_to_string({_mask_sql()}, ',') AS feature_mask,
       array_to_string(list_concat(known, CAST(repeat([0], {SEQ_LEN} - len(known)) AS INTEGER[])), ',') AS known,
       CAST(least(n_tokens, {SEQ_LEN}) - 1 AS INTEGER) AS label_step
FROM ex""")
register("examples_repeated_keys", f"""WITH e AS ({ORACLE["encoded_padded"]})
SELECT CASE WHEN d.source <> 'src0' THEN d.source END AS source_key, e.n_tokens, e.truncated, e.features, e.known, e.label_step
FROM e JOIN documents d ON e.doc_id = d.doc_id""")
_QSRC = labelled_sql("quality")
register("label_steps", f"""WITH {examples_sql(_QSRC, True)}
SELECT doc_id, label_id, n_tokens, CAST(least(n_tokens, {SEQ_LEN}) - 1 AS INTEGER) AS label_step,
       n_tokens > {SEQ_LEN} AS truncated FROM ex""")
register("example_cells", f"""WITH {examples_sql(_QSRC, True)},
e AS (SELECT *, CAST(least(n_tokens, {SEQ_LEN}) - 1 AS INTEGER) AS label_step FROM ex)
SELECT doc_id, 'features' AS tensor, 0 AS i, CAST(unnest(range(len(ids))) AS INTEGER) AS j,
       CAST(unnest(ids) AS DOUBLE) AS value FROM e
UNION ALL
SELECT doc_id, 'feature_mask', 0, CAST(unnest(range(least(n_tokens, {SEQ_LEN}))) AS INTEGER), 1.0 FROM e
UNION ALL
SELECT doc_id, 'labels', label_id, label_step, 1.0 FROM e
UNION ALL
SELECT doc_id, 'label_mask', 0, label_step, 1.0 FROM e""")
register("example_tensors", f"""WITH {examples_sql(_QSRC, True)},
e AS (SELECT *, CAST(least(n_tokens, {SEQ_LEN}) - 1 AS INTEGER) AS label_step FROM ex),
rows AS (
  SELECT doc_id, 'features' AS tensor, 0 AS i, list_concat(ids, CAST(repeat([0], {SEQ_LEN} - len(ids)) AS BIGINT[])) AS row FROM e
  UNION ALL SELECT doc_id, 'feature_mask', 0, {_mask_sql()} FROM e
  UNION ALL SELECT doc_id, 'label_mask', 0, list_transform(range({SEQ_LEN}), lambda j: CAST(j = label_step AS BIGINT)) FROM e
  UNION ALL SELECT doc_id, 'labels', CAST(c AS INTEGER),
                   list_transform(range({SEQ_LEN}), lambda j: CAST(j = label_step AND c = label_id AS BIGINT))
            FROM e, unnest(range(2)) AS u(c))
SELECT doc_id, tensor, i, array_to_string(row, ',') AS row FROM rows""")
ORACLE["example_cells"] = f"SELECT * FROM ({ORACLE['example_cells']}) WHERE value <> 0"
ORACLE["tensors_roundtrip"] = ORACLE["example_cells"]


# ---------------------------------------------------------------- step 4 ---

_TOKID = f"""{VOCAB_CTE},
tid AS (SELECT d.doc_id, d.pos, d.word, v.idx FROM dtok d JOIN vocab v ON d.word = v.word)"""
register("token_json", f"""WITH {_TOKID}
SELECT doc_id, CAST(to_json(list(CAST(to_json({{'word': word, 'index': idx}}) AS VARCHAR) ORDER BY pos)) AS VARCHAR) AS json
FROM tid GROUP BY doc_id""")
register("token_json_roundtrip", f"WITH {VOCAB_CTE} SELECT word, CAST(idx AS DOUBLE) AS index FROM vocab")

register("first_match_conflicts", f"""SELECT word, CAST(pos AS DOUBLE) AS index FROM (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id, pos) AS rn FROM ({doc_tok_sql()})) WHERE rn = 1""")
register("lines_roundtrip", """
SELECT text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents) GROUP BY text""")
register("numbered_lines", """
SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS line_id, text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i
      FROM documents WHERE text IS NOT NULL)""")
register("tsv_checked", """
WITH lines AS (SELECT unnest(string_split(concat_ws(chr(9), lang, text), chr(10))) AS line FROM documents),
f AS (SELECT line, string_split(line, chr(9)) AS f, CASE WHEN line = '' THEN 'empty' WHEN instr(line, chr(9)) = 0 THEN 'one_field'
        WHEN line[1] = chr(9) THEN 'no_label' END AS reason FROM lines)
SELECT CASE WHEN reason IS NULL THEN f[1] END AS label, CASE WHEN reason IS NULL THEN f[2] ELSE line END AS text, reason FROM f""")
register("token_json_checked", f"""WITH {VOCAB_CTE},
flags AS (SELECT CAST(quality AS VARCHAR) AS q FROM labels),
turns AS (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations),
rows AS (
  SELECT word AS value, '' AS reason FROM dtok
  UNION ALL SELECT line, 'no_json' FROM turns
  UNION ALL SELECT '{{"index":' || q || '}}', 'no_word' FROM flags
  UNION ALL SELECT q, 'bad_item' FROM flags
  UNION ALL SELECT 'word', 'bad_item' FROM flags
  UNION ALL SELECT '[]', 'no_item' FROM flags)
SELECT value, reason, count(*) AS n FROM rows GROUP BY value, reason""")
register("tsv_roundtrip", f"""
SELECT lang AS label, joined AS text
FROM (SELECT lang, array_to_string({tokens_sql('text')}, ' ') AS joined FROM documents) WHERE length(joined) > 0""")
register("examples_roundtrip", f"""WITH {examples_sql(_QSRC, True)}
SELECT doc_id, label_id, n_tokens, CAST(list_sum(ids) AS BIGINT) AS id_sum,
       CAST(least(n_tokens, {SEQ_LEN}) AS BIGINT) AS mask_sum FROM ex""")

# ---------------------------------------------------------------- step 5 ---

# A-z, A-Z, 0-9 and 15 marks, in the order of their ids.
CHARSET = [*"abcdefghijklmnopqrstuvwxyz", *"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *"0123456789",
           *"!&()?-'\",.:; ", "\n", "\t"]

_OUTSIDE = r"""'[^a-zA-Z0-9!&()?\-''",.:; \n\t]'"""


def _sql_char(c: str) -> str:
    return {"\n": "chr(10)", "\t": "chr(9)", "'": "''''"}.get(c, f"'{c}'")


_CHARSET_LIST = "[" + ", ".join(_sql_char(c) for c in CHARSET) + "]"
_CHAR_CTE = f"""filt AS (SELECT doc_id, regexp_replace(text, {_OUTSIDE}, '', 'g') AS text FROM documents),
chunks AS (SELECT doc_id, CAST(c AS INTEGER) AS chunk, substr(text, CAST(c * {CHUNK_LEN} + 1 AS BIGINT), {CHUNK_LEN}) AS text
           FROM filt, unnest(range((length(text) + {CHUNK_LEN - 1}) // {CHUNK_LEN})) AS u(c)),
pairs AS (SELECT doc_id, CAST(unnest(range(greatest(0, length(text) - 1))) AS INTEGER) AS pos,
                 unnest(string_split(text[:-2], '')) AS ch, unnest(string_split(text[2:], '')) AS next_ch
          FROM filt WHERE length(text) > 1),
trans AS (SELECT ch, next_ch, count(*) AS n FROM pairs GROUP BY ch, next_ch),
cdf AS (SELECT ch, next_ch, n,
               CAST(sum(n) OVER (PARTITION BY ch ORDER BY next_ch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum,
               CAST(sum(n) OVER (PARTITION BY ch) AS BIGINT) AS total FROM trans),
cdf2 AS (SELECT *, cum - n AS prev FROM cdf)"""

register("charset_filtered", f"WITH {_CHAR_CTE} SELECT doc_id, text FROM filt")
register("chunks", f"WITH {_CHAR_CTE} SELECT doc_id, chunk, text FROM chunks")
register("char_ids", f"""WITH {_CHAR_CTE},
cs AS (SELECT CAST(unnest(range(77)) AS INTEGER) AS char_id, unnest({_CHARSET_LIST}) AS ch),
chars AS (SELECT doc_id, chunk, CAST(i AS INTEGER) AS pos, substr(text, CAST(i + 1 AS BIGINT), 1) AS ch
          FROM chunks, unnest(range(length(text))) AS u(i))
SELECT c.doc_id, c.chunk, c.pos, c.ch, s.char_id FROM chars c JOIN cs s ON c.ch = s.ch""")
register("char_pairs", f"WITH {_CHAR_CTE} SELECT doc_id, pos, ch, next_ch FROM pairs")
register("one_hot_chars", f"""WITH {_CHAR_CTE},
cs AS (SELECT CAST(unnest(range(77)) AS INTEGER) AS char_id, unnest({_CHARSET_LIST}) AS ch)
SELECT p.doc_id, 'features' AS tensor, a.char_id, p.pos, CAST(1.0 AS DOUBLE) AS value
FROM pairs p JOIN cs a ON p.ch = a.ch JOIN cs b ON p.next_ch = b.ch
UNION ALL
SELECT p.doc_id, 'labels', b.char_id, p.pos, 1.0
FROM pairs p JOIN cs a ON p.ch = a.ch JOIN cs b ON p.next_ch = b.ch""")
register("transitions", f"WITH {_CHAR_CTE} SELECT ch, next_ch, n FROM trans")
register("transition_cdf", f"WITH {_CHAR_CTE} SELECT ch, next_ch, n, cum, total FROM cdf")
register("draws", f"""WITH {_CHAR_CTE},
req AS (SELECT doc_id, chunk, CAST(doc_id AS VARCHAR) || ':' || CAST(chunk AS VARCHAR) AS req_id,
               substr(text, -1, 1) AS ch FROM chunks),
rq AS (SELECT q.*, CAST({hash_sql('q.req_id', 12345, 1 << 40)} % t.total AS BIGINT) AS r
       FROM req q LEFT JOIN (SELECT DISTINCT ch, total FROM cdf) t ON q.ch = t.ch)
SELECT rq.doc_id, rq.chunk, rq.req_id, rq.ch, rq.r, c.next_ch AS drawn
FROM rq LEFT JOIN cdf2 c ON c.ch = rq.ch AND rq.r >= c.prev AND rq.r < c.cum""")
_WORD_CDF = f"""wpairs AS (
  SELECT unnest(toks[:-2]) AS word, unnest(toks[2:]) AS next_word FROM (SELECT {tokens_sql('text')} AS toks FROM documents)
  WHERE len(toks) > 1),
wtrans AS (SELECT word, next_word, count(*) AS n FROM wpairs GROUP BY word, next_word),
wcdf AS (SELECT word, next_word, n,
                CAST(sum(n) OVER (PARTITION BY word ORDER BY next_word ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum,
                CAST(sum(n) OVER (PARTITION BY word) AS BIGINT) AS total FROM wtrans)"""
register("word_cdf", f"WITH {_WORD_CDF} SELECT * FROM wcdf")
_WORD_KEY = "CAST(q.conv_id AS VARCHAR) || ':' || CAST(q.turn AS VARCHAR) || ':' || CAST(q.pos AS VARCHAR)"
register("word_draws", f"""WITH {_WORD_CDF}, ctok AS ({CONV_TOK}),
req AS (SELECT q.*, {_WORD_KEY} AS req_id FROM ctok q),
rq AS (SELECT q.*, CAST({hash_sql('q.req_id', 12345, 1 << 40)} % t.total AS BIGINT) AS r
       FROM req q LEFT JOIN (SELECT DISTINCT word, total FROM wcdf) t ON q.word = t.word)
SELECT rq.conv_id, rq.turn, rq.pos, rq.word, rq.req_id, rq.r, c.next_word AS drawn
FROM rq LEFT JOIN wcdf c ON c.word = rq.word AND rq.r >= c.cum - c.n AND rq.r < c.cum""")
_SEEDS = f"""seeds AS (SELECT doc_id, CAST({hash_sql('doc_id', 12345, 77)} AS INTEGER) AS char_id FROM documents),
seeds2 AS (SELECT doc_id, char_id, {_CHARSET_LIST}[char_id + 1] AS seed_ch FROM seeds)"""
register("seed_chars", f"WITH {_SEEDS} SELECT doc_id, char_id, seed_ch FROM seeds2")
_GEN_CTE = (_CHAR_CTE.replace("cdf2 AS (", "cdf2 AS MATERIALIZED (")
            + ",\n" + _SEEDS.replace("seeds2 AS (", "seeds2 AS MATERIALIZED ("))
register("generated_text", f"""WITH RECURSIVE {_GEN_CTE},
gen(doc_id, step, last, txt) AS (
  SELECT doc_id, 0, seed_ch, seed_ch FROM seeds2
  UNION ALL
  SELECT g.doc_id, g.step + 1, c.next_ch, g.txt || c.next_ch
  FROM gen g JOIN cdf2 c ON c.ch = g.last
   AND {hash_sql("CAST(g.doc_id AS VARCHAR) || ':' || CAST(g.step + 1 AS VARCHAR)", 12345, 1 << 40)} % c.total >= c.prev
   AND {hash_sql("CAST(g.doc_id AS VARCHAR) || ':' || CAST(g.step + 1 AS VARCHAR)", 12345, 1 << 40)} % c.total < c.cum
  WHERE g.step < {GEN_STEPS})
SELECT doc_id, txt AS generated FROM gen
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY step DESC) = 1""")


_PREFIX = f"""pre AS (
  SELECT conv_id, turn, s AS sample, prefix,
         CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) || '/' || CAST(s AS VARCHAR) AS key
  FROM (SELECT conv_id, turn, regexp_replace(text, {_OUTSIDE}, '', 'g') AS prefix FROM conversations), unnest(range(4)) AS u(s)
  WHERE length(prefix) > 0)"""
_DRAWN = hash_sql("g.key || ':' || CAST(g.step + 1 AS VARCHAR)", 12345, 1 << 40)
register("generated_samples", f"""WITH RECURSIVE {_CHAR_CTE.replace("cdf2 AS (", "cdf2 AS MATERIALIZED (")}, {_PREFIX},
gen(conv_id, turn, sample, key, step, last, txt) AS (
  SELECT conv_id, turn, sample, key, 0, substr(prefix, -1, 1), '' FROM pre
  UNION ALL
  SELECT g.conv_id, g.turn, g.sample, g.key, g.step + 1, c.next_ch, g.txt || c.next_ch
  FROM gen g JOIN cdf2 c ON c.ch = g.last AND {_DRAWN} % c.total >= c.prev AND {_DRAWN} % c.total < c.cum
  WHERE g.step < {GEN_STEPS}),
longest AS (SELECT * FROM gen QUALIFY row_number() OVER (PARTITION BY key ORDER BY step DESC) = 1)
SELECT p.conv_id, p.turn, p.prefix, CAST(p.sample AS INTEGER) AS sample, p.prefix || l.txt AS generated
FROM pre p JOIN longest l ON p.key = l.key""")


# ---------------------------------------------------------------- step 6 ---

# At every offset the next 64 characters (more than the longest word has), and of
# these every beginning of a length that the dictionary has.
_MATCHES = f"""ctok AS ({CONV_TOK}),
dict AS (SELECT DISTINCT word FROM ctok),
lens AS (SELECT DISTINCT length(word) AS l FROM dict),
d AS (SELECT doc_id, unnest(string_split(lower(text), '')) AS c, CAST(unnest(range(length(text))) AS INTEGER) AS start
      FROM documents),
w AS (SELECT doc_id, start, string_agg(c, '') OVER (
        PARTITION BY doc_id ORDER BY start ROWS BETWEEN CURRENT ROW AND 63 FOLLOWING) AS w FROM d),
cand AS (SELECT doc_id, start, substr(w, 1, l) AS word FROM w, lens WHERE l <= length(w)),
hits AS (SELECT doc_id, start, word FROM cand WHERE word IN (SELECT word FROM dict))"""
register("dictionary_matches", f"WITH {_MATCHES} SELECT doc_id, start, word FROM hits")
register("score_unspaced", f"""WITH {counted_sql('lang')}, {_MATCHES},
hs AS (SELECT h.doc_id, coalesce(m.n0, 0) AS n0, coalesce(m.n1, 0) AS n1, coalesce(m.n2, 0) AS n2,
              coalesce(m.n3, 0) AS n3, coalesce(m.n_word, 0) AS n_word FROM hits h LEFT JOIN model m ON h.word = m.word),
hm AS (SELECT doc_id, [{', '.join(f"round(sum((n{c} + 1)::DOUBLE / (n_word + 4)) / count(*), 6)" for c in range(4))}] AS m
       FROM hs GROUP BY doc_id)
SELECT doc_id, CAST(list_position(m, list_max(m)) - 1 AS INTEGER) AS class_id, list_max(m) AS mean_score,
       ['de', 'en', 'es', 'fr'][list_position(m, list_max(m))] AS label FROM hm""")
# The lattice of all words in a text, then the least sum to each position, one more a
# step (of the last 63 positions, more than any word has); the way back from the end.
_STRIPPED = f"regexp_replace(lower(regexp_replace(text, {STRIP}, '', 'g')), {BLANKS}, '', 'g')"
_SEGMENTS = f"""dtok AS ({doc_tok_sql()}),
counts AS (SELECT word, count(*) AS n, sum(count(*)) OVER () AS total FROM dtok GROUP BY word),
dict AS (SELECT word, CAST(round(1000 * ln(total::DOUBLE / n)) AS BIGINT) AS cost FROM counts),
unseen AS (SELECT CAST(round(1000 * ln(max(total)::DOUBLE)) AS BIGINT) + 5000 AS late FROM counts),
lens AS (SELECT DISTINCT length(word) AS l FROM dict),
txt AS MATERIALIZED (SELECT row_number() OVER () AS id, conv_id, turn, {_STRIPPED} AS s FROM conversations),
places AS (SELECT id, s, unnest(range(length(s))) AS start FROM txt),
hits AS MATERIALIZED (SELECT p.id, CAST(p.start AS INTEGER) AS start, CAST(p.start + l AS INTEGER) AS stop, d.word, d.cost
  FROM places p JOIN lens ON p.start + l <= length(p.s) JOIN dict d ON d.word = substr(p.s, p.start + 1, l)),
cand AS MATERIALIZED (SELECT id, stop, list({{'start': start, 'cost': cost}}) AS ways FROM hits GROUP BY id, stop),
dp(id, i, best, start, known) AS (
  SELECT id, 0, [{{'c': 0::BIGINT, 'w': 0::BIGINT}}], NULL::INTEGER, NULL::BOOLEAN FROM txt
  UNION ALL
  SELECT id, i, list_append(best, {{'c': way.c, 'w': way.w}})[-63:], way.s, way.known FROM (
    SELECT id, i, best, list_min(list_append(
      list_transform(coalesce(ways, []), lambda x: {{'c': best[len(best) - (i - 1 - x.start)].c + x.cost,
        'w': best[len(best) - (i - 1 - x.start)].w + 1, 's': x.start, 'known': true}}),
      {{'c': best[-1].c + late, 'w': best[-1].w + 1, 's': i - 1, 'known': false}})) AS way
    FROM (SELECT d.id, d.i + 1 AS i, d.best, c.ways, (SELECT late FROM unseen) AS late
          FROM dp d JOIN txt t ON d.id = t.id AND d.i < length(t.s) LEFT JOIN cand c ON c.id = d.id AND c.stop = d.i + 1))),
laid AS MATERIALIZED (SELECT id, i, start, known FROM dp WHERE i > 0),
path(id, stop, start, known) AS (
  SELECT s.id, s.i, s.start, s.known FROM laid s JOIN txt t ON s.id = t.id AND s.i = length(t.s)
  UNION ALL
  SELECT s.id, s.i, s.start, s.known FROM path p JOIN laid s ON s.id = p.id AND s.i = p.start),
chosen AS MATERIALIZED (SELECT t.conv_id, t.turn, p.*, substr(t.s, p.start + 1, p.stop - p.start) AS word
  FROM path p JOIN txt t ON p.id = t.id)"""
register("segmented_words", f"""WITH RECURSIVE {_SEGMENTS}
SELECT conv_id, turn, start, word, known, false AS inner FROM chosen
UNION ALL
SELECT c.conv_id, c.turn, h.start, h.word, true, true
FROM chosen c JOIN hits h ON h.id = c.id AND h.start >= c.start AND h.stop <= c.stop
WHERE length(h.word) > 1 AND h.stop - h.start < c.stop - c.start""")
register("score_segmented", f"""WITH RECURSIVE {counted_sql('lang')}, {_SEGMENTS},
hs AS (SELECT h.conv_id, h.turn, h.id, coalesce(m.n0, 0) AS n0, coalesce(m.n1, 0) AS n1, coalesce(m.n2, 0) AS n2,
              coalesce(m.n3, 0) AS n3, coalesce(m.n_word, 0) AS n_word
       FROM chosen h LEFT JOIN model m ON h.word = m.word WHERE h.known),
hm AS (SELECT conv_id, turn, [{', '.join(f"round(sum((n{c} + 1)::DOUBLE / (n_word + 4)) / count(*), 6)" for c in range(4))}] AS m
       FROM hs GROUP BY conv_id, turn, id)
SELECT conv_id, turn, CAST(list_position(m, list_max(m)) - 1 AS INTEGER) AS class_id, list_max(m) AS mean_score,
       ['de', 'en', 'es', 'fr'][list_position(m, list_max(m))] AS label FROM hm""")
register("hash_split", f"SELECT doc_id, {split_sql('text')} AS is_train FROM documents")
register("split_check", f"""WITH a AS (SELECT doc_id, text, lang FROM documents),
tr AS (SELECT * FROM a WHERE {split_sql('text')}),
te AS (SELECT * FROM a WHERE NOT {split_sql('text')})
SELECT (SELECT count(*) FROM a) AS n_all, (SELECT count(*) FROM tr) AS n_train,
       (SELECT count(*) FROM te) AS n_test,
       (SELECT count(*) FROM (SELECT * FROM tr INTERSECT SELECT * FROM te)) AS n_overlap,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL (SELECT * FROM tr UNION ALL SELECT * FROM te))) AS n_missing,
       (SELECT count(*) FROM ((SELECT * FROM tr UNION ALL SELECT * FROM te) EXCEPT ALL SELECT * FROM a)) AS n_extra""")


# ---------------------------------------------------------------- step 7 ---

# Held-out rows and the most frequent label's; that a trained model beats it is stated, not computed.
_BEATS = f"""WITH lab AS (SELECT * FROM ({labelled_sql('lang')}) WHERE label_id >= 0 AND NOT {split_sql('text')}),
per AS (SELECT label_id, count(*) AS n FROM lab GROUP BY label_id)
SELECT CAST(sum(n) AS BIGINT) AS n_test, max(n) AS n_majority, true AS beats_majority FROM per"""
register("train_linear", _BEATS)
register("train_embedded", _BEATS)
# Every held-out text of the fixtures has a word that is frequent enough for a vector.
register("train_word_vectors", _BEATS)
register("near_words", f"""WITH {VOCAB_CTE},
v AS (SELECT word, idx FROM vocab WHERE freq >= 5),
ids AS (SELECT t.doc_id, t.pos, v.idx FROM dtok t JOIN v ON t.word = v.word),
one AS (SELECT a.idx AS x, b.idx AS y FROM ids a JOIN ids b ON a.doc_id = b.doc_id AND b.pos - a.pos BETWEEN 1 AND 2),
pairs AS (SELECT word_id, other_id, count(*) AS n FROM (
            SELECT x AS word_id, y AS other_id FROM one UNION ALL SELECT y, x FROM one) GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY word_id) AS nw, sum(n) OVER (PARTITION BY other_id) AS nc, sum(n) OVER () AS total FROM pairs),
w AS (SELECT word_id, other_id, log2(n * total::DOUBLE / (nw::DOUBLE * nc)) AS weight FROM m)
SELECT word_id, other_id, round(weight, 6) AS weight FROM w WHERE weight > 0""")

_JOB = f"""WITH src AS (SELECT doc_id, text, len({tokens_sql("coalesce(text, '')")}) AS n, {label_id_sql('lang', LINE_CLASSES)} AS label_id
  FROM documents),
ok AS (SELECT doc_id, text, label_id, {split_sql('text')} AS is_train, {tokens_sql('text')} AS toks FROM src
       WHERE n > 0 AND label_id >= 0),
tok AS (SELECT doc_id, label_id, is_train, unnest(toks) AS word FROM ok),
model AS (SELECT word, count(*) AS n_word, count(*) FILTER (label_id = 0) AS n0, count(*) FILTER (label_id = 1) AS n1
          FROM tok WHERE is_train GROUP BY word),
sc AS (SELECT t.doc_id, t.label_id,
              round(sum((coalesce(m.n0, 0) + 1)::DOUBLE / (coalesce(m.n_word, 0) + 2)) / count(*), 6) AS s0,
              round(sum((coalesce(m.n1, 0) + 1)::DOUBLE / (coalesce(m.n_word, 0) + 2)) / count(*), 6) AS s1
       FROM tok t LEFT JOIN model m ON t.word = m.word WHERE NOT is_train GROUP BY ALL)
SELECT count(*) AS n_test, count(*) FILTER (label_id = CASE WHEN s1 > s0 THEN 1 ELSE 0 END) AS n_correct,
       round(count(*) FILTER (label_id = CASE WHEN s1 > s0 THEN 1 ELSE 0 END) / count(*), 6) AS accuracy,
       (SELECT count(*) FROM src WHERE n = 0 OR label_id < 0) AS n_rejected FROM sc"""
register("train_job", _JOB)


# ---------------------------------------------------------------- step 8 ---

# Same model as predict_lang; every document of the stream is scored.
register("score_stream", "WITH " + counted_sql("lang").replace(
    'test_tok AS (SELECT doc_id, label_id, pos, word FROM tok WHERE NOT is_train)',
    'test_tok AS (SELECT doc_id, label_id, pos, word FROM tok)') + " SELECT * FROM pred")

_LINE = "regexp_replace(string_split(coalesce(text, ''), chr(10))[1], '[a-zA-Z]', '', 'g')"
register("score_stream_rejects", f"""WITH {counted_sql('lang')},
asked AS (SELECT doc_id, {tokens_sql(_LINE)} AS toks FROM documents),
words AS (SELECT doc_id, unnest(toks) AS word FROM asked),
hs AS (SELECT w.doc_id, {', '.join(f"round(sum((coalesce(m.n{c}, 0) + 1)::DOUBLE / (coalesce(m.n_word, 0) + 4)) / count(*), 6) AS m{c}" for c in range(4))}
       FROM words w LEFT JOIN model m ON w.word = m.word GROUP BY w.doc_id),
hm AS (SELECT doc_id, [m0, m1, m2, m3] AS m FROM hs)
SELECT a.doc_id, ['de', 'en', 'es', 'fr'][list_position(m, list_max(m))] AS label,
       CASE WHEN len(a.toks) = 0 THEN 'empty' END AS reason
FROM asked a LEFT JOIN hm ON a.doc_id = hm.doc_id""")
register("mean_scores", "WITH " + counted_sql("quality") + """
SELECT doc_id, class_id, score AS mean_score FROM longf""")
register("token_class_model", "WITH " + counted_sql("lang") + """
SELECT word, CAST(unnest(range(4)) AS INTEGER) AS class_id, CAST(unnest([n0, n1, n2, n3]) AS BIGINT) AS n,
       n_word FROM model""")
register("model_roundtrip", ORACLE["token_class_model"])

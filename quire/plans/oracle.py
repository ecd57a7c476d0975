"""Independent SQL for each registered query, runnable by DuckDB.

The tables are DuckDB views of the same parquet files.  Each statement is
from the Spark code: plain window functions, ``json_*`` functions, list
lambdas and a recursive query for LCS.  Doubles are rounded to 6 places.
"""

from __future__ import annotations

from types import SimpleNamespace

# Fixed values, written out here so that the SQL does not lean on the code it checks.
# Python's white space: 29 code points.
WS_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
WS = "".join(map(chr, WS_CODES))
_CLASS = "".join(f"\\x{{{c:X}}}" for c in WS_CODES)
WS_RUN, WORD_RUN = f"[{_CLASS}]+", f"[^{_CLASS}]+"
V = SimpleNamespace(
    PARSE_ERROR="JSON parse error", MISSING_QUESTION="missing or empty 'question'", MISSING_ANSWER="missing or empty 'answer'",
    BAD_TYPE_QUESTION="bad type for 'question'", BAD_TYPE_ANSWER="bad type for 'answer'",
    SHORT_QUESTION="question too short", SHORT_ANSWER="answer too short")
PR = SimpleNamespace(
    PROFILE_SYSTEM_PROMPT="You are a helpful assistant.",
    TRAIN_SYSTEM_PROMPT="You are a helpful AI assistant. Answer questions accurately and concisely.",
    PLAIN_PREFIX_Q="Q: ", PLAIN_PREFIX_A="\nA: ", INFER_PREFIX="<|user|>\n", INFER_SUFFIX="\n<|assistant|>\n",
    DEFAULT_TEMPLATE=SimpleNamespace(begin="<|begin_of_text|>", role_open="<|start_header_id|>", role_close="<|end_header_id|>\n\n",
                                     end="<|eot_id|>", strip_content=True))
# The 13a tokenizer's rules.
TOK13A_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]

# The bootstrap's mixing constants and Poisson chances.
MASK, STEP, FIRST, SECOND = 2**62 - 1, 0x1E3779B97F4A7C15, 0x3F51AFD7ED558CCD, 0x04CEB9FE1A85EC53
POISSON = [1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463, 4294966817, 4294967252, 4294967292]


def lit(s: str) -> str:
    """A Python string as a DuckDB string expression (newlines through chr(10))."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted) if len(parts) > 1 else quoted[0]


WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WS) + ")"


def trim(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def re_lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# -- shared CTEs --------------------------------------------------------------

PAIRS = """
pairs AS (
  SELECT conv_id * 1000 + turn AS rid, text AS question, a AS answer
  FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS a,
                  lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS ar
        FROM conversations)
  WHERE role = 'user' AND ar = 'assistant'
)"""

_Q = "regexp_replace(question, '[^A-Za-z0-9 .,?]', ' ', 'g')"
_A = "regexp_replace(answer, '[^A-Za-z0-9 .,?]', ' ', 'g')"


def _obj(q: str | None, a: str | None, d: str | None) -> str:
    parts = []
    if q is not None:
        parts.append(f"'\"question\": \"' || {q} || '\"'")
    if a is not None:
        parts.append(f"'\"answer\": \"' || {a} || '\"'")
    if d is not None:
        parts.append(f"'\"domain\": ' || {d}")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


LINES = f"""
f3src AS (
  SELECT rid, q, a, dom, {_obj('q', 'a', 'dom')} AS good
  FROM (SELECT rid, {_Q} AS q, {_A} AS a, '"d' || CAST((rid // 1000) % 3 AS VARCHAR) || '"' AS dom FROM pairs)
),
f3 AS (
  SELECT row_number() OVER (ORDER BY rid) - 1 AS idx,
    CASE rid % 11
      WHEN 0 THEN substr(good, 1, length(good) - 1)
      WHEN 1 THEN {_obj("'   '", 'a', 'dom')}
      WHEN 2 THEN {_obj('q', None, 'dom')}
      WHEN 3 THEN {_obj("'why?'", 'a', 'dom')}
      WHEN 4 THEN {_obj('q', "'yes'", 'dom')}
      WHEN 5 THEN good || ' xyz'
      WHEN 6 THEN {_obj('q', 'a', None)}
      WHEN 7 THEN {_obj('q', 'a', "'null'")}
      WHEN 8 THEN {_obj("'  a  '", 'a', 'dom')}
      WHEN 9 THEN ''
      ELSE {_obj("'  ' || q || '  '", "'  ' || a || '  '", 'dom')}
    END AS raw
  FROM f3src
),
lines AS (SELECT idx, {trim('raw')} AS line FROM f3 WHERE {trim('raw')} <> ''),
parsed AS (
  SELECT idx, line, ok,
         CASE WHEN ok THEN json_type(line, '$.question') END AS qt,
         CASE WHEN ok THEN json_type(line, '$.answer') END AS atp,
         CASE WHEN ok THEN json_extract_string(line, '$.question') END AS qv,
         CASE WHEN ok THEN json_extract_string(line, '$.answer') END AS av,
         CASE WHEN ok THEN json_type(line, '$.domain') END AS dt,
         CASE WHEN ok THEN json_extract_string(line, '$.domain') END AS dv
  FROM (SELECT idx, line, json_valid(line) AS ok FROM lines)
),
validated AS (
  SELECT *, CASE
    WHEN NOT ok THEN {lit(V.PARSE_ERROR)}
    WHEN qt IS NULL THEN {lit(V.MISSING_QUESTION)}
    WHEN qt <> 'VARCHAR' THEN {lit(V.BAD_TYPE_QUESTION)}
    WHEN {trim('qv')} = '' THEN {lit(V.MISSING_QUESTION)}
    WHEN atp IS NULL THEN {lit(V.MISSING_ANSWER)}
    WHEN atp <> 'VARCHAR' THEN {lit(V.BAD_TYPE_ANSWER)}
    WHEN {trim('av')} = '' THEN {lit(V.MISSING_ANSWER)}
    WHEN length(qv) < 5 THEN {lit(V.SHORT_QUESTION)}
    WHEN length(av) < 10 THEN {lit(V.SHORT_ANSWER)}
  END AS reason
  FROM parsed
),
clean AS (
  SELECT idx AS rid, {trim('qv')} AS question, {trim('av')} AS answer,
         CASE WHEN dt IS NULL THEN 'general' ELSE dv END AS domain
  FROM validated WHERE reason IS NULL
)"""

DOCS = f"""
docs AS (
  SELECT doc_id AS rid,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS question,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS answer,
    source AS domain
  FROM documents
),
docs_v AS (
  SELECT *, CASE
    WHEN question IS NULL OR {trim('question')} = '' THEN {lit(V.MISSING_QUESTION)}
    WHEN answer IS NULL OR {trim('answer')} = '' THEN {lit(V.MISSING_ANSWER)}
    WHEN length(question) < 5 THEN {lit(V.SHORT_QUESTION)}
    WHEN length(answer) < 10 THEN {lit(V.SHORT_ANSWER)}
  END AS reason
  FROM docs
),
docs_clean AS (
  SELECT rid, {trim('question')} AS question, {trim('answer')} AS answer, domain FROM docs_v WHERE reason IS NULL
)"""


def chat_text(system: str, q: str = "question", a: str = "answer") -> str:
    t = PR.DEFAULT_TEMPLATE

    def msg(role: str, content: str) -> str:
        return f"{lit(t.role_open + role + t.role_close)} || {trim(content)} || {lit(t.end)}"

    return f"{lit(t.begin)} || {msg('system', lit(system))} || {msg('user', q)} || {msg('assistant', a)}"


def word_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {re_lit(WORD_RUN)})) AS BIGINT)"


def lengths_cte(src: str) -> str:
    return f"lens AS (SELECT rid, {word_count(chat_text(PR.PROFILE_SYSTEM_PROMPT))} AS n_tokens FROM {src})"


def report_sql(len_cte: str) -> str:
    return f"""
{len_cte},
ranked AS (SELECT n_tokens, row_number() OVER (ORDER BY n_tokens) - 1 AS i, count(*) OVER () AS n FROM lens)
SELECT count(*)::BIGINT AS n, round(avg(n_tokens), 6) AS mean_tokens, max(n_tokens)::BIGINT AS max_tokens,
  (SELECT max(n_tokens) FROM ranked WHERE i = floor(CAST(0.95 AS DOUBLE) * n))::BIGINT AS p95_tokens,
  count(*) FILTER (WHERE n_tokens > 512)::BIGINT AS n_over,
  round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE n_tokens > 512) / count(*), 6) AS pct_over
FROM lens"""


def p95_sql(len_cte: str) -> str:
    return f"""
{len_cte},
ranked AS (SELECT n_tokens, row_number() OVER (ORDER BY n_tokens) - 1 AS i, count(*) OVER () AS n FROM lens)
SELECT (SELECT count(*) FROM lens)::BIGINT AS n,
       (SELECT max(n_tokens) FROM ranked WHERE i = floor(CAST(0.95 AS DOUBLE) * n))::BIGINT AS p95"""


def positions(salt: str = "") -> str:
    return f"""
pos AS (SELECT rid, row_number() OVER (ORDER BY md5(CAST(rid AS VARCHAR) || ':42{salt}'), rid) - 1 AS pos,
               count(*) OVER () AS n FROM pairs)"""


def dense_positions(salt: str = "") -> str:
    """The keyed permutation of row numbers: six rounds over two digits, again while the result is no row's number."""
    def digest(digit: str, i: int) -> str:
        return f"CAST('0x' || substr(md5('42:{salt}:{i}:' || {digit}), 1, 15) AS BIGINT)"

    def rounds(src: str, x: str) -> str:
        sql = f"SELECT rid, n, a, b, {x} // b AS l, {x} % b AS r FROM {src}"
        for i in range(6):
            digit = f"(l + {digest('r', i)}) % a AS l, r" if i % 2 == 0 else f"l, (r + {digest('l', i)}) % b AS r"
            sql = f"SELECT rid, n, a, b, {digit} FROM ({sql})"
        return f"SELECT rid, n, a, b, l * b + r AS y FROM ({sql})"

    return f"""
numbered AS (SELECT rid, row_number() OVER (ORDER BY rid) - 1 AS idx, count(*) OVER () AS n FROM docs_clean),
based AS (SELECT rid, idx, n, a, (n + a - 1) // a AS b FROM (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered)),
walk AS ({rounds('based', 'idx')} UNION ALL SELECT * FROM ({rounds('(SELECT * FROM walk WHERE y >= n)', 'y')})),
pos AS (SELECT rid, y AS pos, n FROM walk WHERE y < n),
records AS (SELECT rid, md5(concat_ws(chr(10), question, answer, domain)) AS record FROM docs_clean)"""


SPLIT = """
split AS (SELECT rid, pos, CASE
    WHEN pos < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
    WHEN pos < floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val'
    ELSE 'test' END AS split FROM pos)"""

PREDS = """
preds0 AS (
  SELECT rid, answer, label, kept, len(kept) // 2 AS h FROM (
    SELECT rid, answer, 'base' AS label, list_filter(string_split(answer, ' '), lambda w, i: (i - 1) % 2 <> 1) AS kept FROM pairs
    UNION ALL
    SELECT rid, answer, 'finetuned', list_filter(string_split(answer, ' '), lambda w, i: (i - 1) % 5 <> 4) FROM pairs)
),
preds AS (
  SELECT label, rid, array_to_string(CASE WHEN (rid // 1000) % 2 = 1 THEN kept[h + 1:] || kept[1:h] ELSE kept END, ' ')
         AS prediction
  FROM preds0
),
e2 AS (SELECT p.label, p.rid, p.prediction, q.answer AS reference FROM preds p JOIN pairs q ON p.rid = q.rid)"""


def tok13a(x: str) -> str:
    s = x
    s = f"replace(replace({s}, '<skipped>', ''), '-' || chr(10), '')"
    s = f"replace({s}, chr(10), ' ')"
    s = f"replace(replace(replace(replace({s}, '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
    s = f"(' ' || {s} || ' ')"
    for pattern, repl in TOK13A_RULES:
        s = f"regexp_replace({s}, {re_lit(pattern)}, {re_lit(repl.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2'))}, 'g')"
    return f"list_filter(regexp_split_to_array({s}, {re_lit(WS_RUN)}), lambda t: t <> '')"


def tok_rouge(x: str) -> str:
    return f"list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> '')"


def grams(col: str, n: int) -> str:
    if n == 1:
        return f"unnest({col})"
    return f"unnest(list_transform(range(1, len({col}) - {n} + 2), lambda i: array_to_string({col}[i:i + {n - 1}], ' ')))"


def hits_cte(kind: str, pcol: str, rcol: str, orders: list[int]) -> str:
    pg = " UNION ALL ".join(f"SELECT label, rid, {n} AS n, {grams(pcol, n)} AS g FROM toks" for n in orders)
    rg = " UNION ALL ".join(f"SELECT label, rid, {n} AS n, {grams(rcol, n)} AS g FROM toks" for n in orders)
    return f"""
{kind}_pc AS (SELECT label, rid, n, g, count(*) AS c FROM ({pg}) GROUP BY ALL),
{kind}_rc AS (SELECT label, rid, n, g, count(*) AS c FROM ({rg}) GROUP BY ALL),
{kind}_hits AS (SELECT p.label, p.rid, p.n, sum(least(p.c, r.c)) AS hits
                FROM {kind}_pc p JOIN {kind}_rc r ON p.label = r.label AND p.rid = r.rid AND p.n = r.n AND p.g = r.g
                GROUP BY ALL)"""


TOKS = f"""
toks AS (SELECT label, rid, {tok13a('prediction')} AS pb, {tok13a('reference')} AS rb,
                {tok_rouge('prediction')} AS pr, {tok_rouge('reference')} AS rr FROM e2)"""

BLEU = f"""
{hits_cte('b', 'pb', 'rb', [1, 2, 3, 4])},
bt AS (SELECT label, sum(len(pb)) AS c, sum(len(rb)) AS r,
        {", ".join(f"sum(greatest(len(pb) - {n - 1}, 0)) AS t{n}" for n in range(1, 5))}
       FROM toks GROUP BY label),
bm AS (SELECT label, {", ".join(f"coalesce(sum(hits) FILTER (WHERE n = {n}), 0) AS m{n}" for n in range(1, 5))}
       FROM b_hits GROUP BY label),
bp AS (SELECT bt.*, {", ".join(f"coalesce(bm.m{n}, 0) AS m{n}" for n in range(1, 5))},
        {", ".join(f"CASE WHEN t{n} > 0 THEN coalesce(bm.m{n}, 0) / CAST(t{n} AS DOUBLE) ELSE 0.0 END AS p{n}" for n in range(1, 5))}
       FROM bt LEFT JOIN bm USING (label)),
bleu AS (SELECT label, c, r, {", ".join(f"m{n}, t{n}" for n in range(1, 5))},
   CASE WHEN c > r THEN 1.0 WHEN c > 0 THEN exp(1.0 - 1.0 / (c / CAST(r AS DOUBLE))) ELSE 0.0 END AS bpen,
   CASE WHEN p1 > 0 AND p2 > 0 AND p3 > 0 AND p4 > 0
        THEN exp(0.25 * ln(p1) + 0.25 * ln(p2) + 0.25 * ln(p3) + 0.25 * ln(p4)) ELSE 0.0 END AS geo
  FROM bp)"""

ROUGE_N = f"""
{hits_cte('r', 'pr', 'rr', [1, 2])},
rrows AS (SELECT t.label, t.rid, o.n, coalesce(h.hits, 0) AS hits,
            greatest(len(t.pr) - o.n + 1, 0) AS pc, greatest(len(t.rr) - o.n + 1, 0) AS rc
          FROM toks t CROSS JOIN (VALUES (1), (2)) o(n)
          LEFT JOIN r_hits h ON h.label = t.label AND h.rid = t.rid AND h.n = o.n),
rf AS (SELECT label, rid, n, hits / CAST(greatest(pc, 1) AS DOUBLE) AS p, hits / CAST(greatest(rc, 1) AS DOUBLE) AS r FROM rrows),
rn AS (SELECT label,
         avg(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END) FILTER (WHERE n = 1) AS rouge1,
         avg(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END) FILTER (WHERE n = 2) AS rouge2
       FROM rf GROUP BY label)"""

# LCS by dynamic programming, one DP row per recursion step: the row for
# prediction token i is the running max over j of
# max(prev[j], prev[j-1] + 1 if ref[j] = pred[i]).
ROUGE_L = """
lt AS (SELECT label, rid, pr, rr, len(pr) AS m, len(rr) AS nn FROM toks),
ref_tok AS (SELECT label, rid, generate_subscripts(rr, 1) AS j, unnest(rr) AS tok FROM lt),
pred_tok AS (SELECT label, rid, generate_subscripts(pr, 1) AS i, unnest(pr) AS tok FROM lt),
dp(label, rid, i, j, v) AS (
  SELECT label, rid, 0, j, 0 FROM (SELECT label, rid, unnest(range(0, nn + 1)) AS j FROM lt WHERE m > 0 AND nn > 0)
  UNION ALL
  SELECT label, rid, i, j, max(cand) OVER (PARTITION BY label, rid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (
    SELECT d.label, d.rid, d.i + 1 AS i, d.j,
      greatest(d.v, CASE WHEN rt.tok = pt.tok
                         THEN lag(d.v) OVER (PARTITION BY d.label, d.rid ORDER BY d.j) + 1 ELSE 0 END) AS cand
    FROM dp d
    JOIN pred_tok pt ON pt.label = d.label AND pt.rid = d.rid AND pt.i = d.i + 1
    LEFT JOIN ref_tok rt ON rt.label = d.label AND rt.rid = d.rid AND rt.j = d.j
  )
),
lcs AS (SELECT l.label, l.rid, l.m, l.nn, coalesce(d.v, 0) AS lcs
        FROM lt l LEFT JOIN dp d ON d.label = l.label AND d.rid = l.rid AND d.i = l.m AND d.j = l.nn),
rl AS (SELECT label, avg(CASE WHEN m = 0 OR nn = 0 THEN 0.0
                             WHEN lcs = 0 THEN 0.0
                             ELSE 2.0 * (lcs / CAST(m AS DOUBLE)) * (lcs / CAST(nn AS DOUBLE))
                                  / (lcs / CAST(m AS DOUBLE) + lcs / CAST(nn AS DOUBLE)) END) AS rougeL
       FROM lcs GROUP BY label)"""


FIRST_SENTENCE = "regexp_extract(question, '^[^.?!]*[.?!]?', 0)"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


_VAL = with_(PAIRS, LINES)
_DOC = with_(DOCS)
_E2 = with_(PAIRS, PREDS)
_SCORE = with_(PAIRS, PREDS, TOKS)

METRICS4 = f"""
{_SCORE}, {BLEU}, {ROUGE_N}, {ROUGE_L},
e6 AS (SELECT b.label, round(geo * bpen, 4) AS bleu, round(rouge1, 4) AS rouge1, round(rouge2, 4) AS rouge2,
              round(rougeL, 4) AS rougeL
       FROM bleu b JOIN rn USING (label) JOIN rl USING (label))"""

ORACLE: dict[str, str] = {
    "s1_doc_lines": f"""SELECT rid, idx, line FROM (
        SELECT doc_id AS rid, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS idx,
               {trim('unnest(string_split(text, chr(10)))')} AS line
        FROM documents) WHERE line <> ''""",
    "s2_strict_json": f"{_VAL} SELECT idx, ok AS parse_ok FROM parsed",
    "s2_doc_json": f"{_DOC} SELECT rid, json_valid(to_json({{'question': question, 'answer': answer, 'domain': domain}})::VARCHAR) AS parse_ok FROM docs",
    "v2_doc_json": f"{_DOC} SELECT rid, question, answer, coalesce(domain, 'general') AS domain FROM docs_clean",
    "v1_reasons": f"{_VAL} SELECT idx, reason FROM validated",
    "v1_doc_reasons": f"{_DOC} SELECT rid, reason FROM docs_v",
    "v2_clean": f"{_VAL} SELECT rid, question, answer, domain FROM clean",
    "v2_doc_clean": f"{_DOC} SELECT rid, question, answer, domain FROM docs_clean",
    "v3_rejects": f"{_VAL} SELECT idx, reason, 'Row ' || CAST(idx AS VARCHAR) || ': ' || reason AS message "
                  f"FROM validated WHERE reason IS NOT NULL",
    "v4_first_rejects": f"{_VAL} SELECT idx, reason, 'Row ' || CAST(idx AS VARCHAR) || ': ' || reason AS message "
                        f"FROM validated WHERE reason IS NOT NULL ORDER BY idx LIMIT 5",
    "a1_counts": f"{_VAL} SELECT count(*) FILTER (WHERE ok)::BIGINT AS total_raw, "
                 f"count(*) FILTER (WHERE reason IS NULL)::BIGINT AS total_clean, "
                 f"count(*) FILTER (WHERE reason IS NOT NULL)::BIGINT AS dropped FROM validated",
    "a2_domains": f"{_VAL} SELECT domain, count(*)::BIGINT AS n FROM clean GROUP BY domain",
    "a2_doc_domains": f"{_DOC} SELECT domain, count(*)::BIGINT AS n FROM docs_clean GROUP BY domain",
    "a3_lengths": f"{_VAL} SELECT CAST(round_even(coalesce(avg(length(question)), 0), 0) AS BIGINT) AS avg_question_len, "
                  f"CAST(round_even(coalesce(avg(length(answer)), 0), 0) AS BIGINT) AS avg_answer_len FROM clean",
    "a3_doc_lengths": f"{_DOC} SELECT CAST(round_even(coalesce(avg(length(question)), 0), 0) AS BIGINT) AS avg_question_len, "
                      f"CAST(round_even(coalesce(avg(length(answer)), 0), 0) AS BIGINT) AS avg_answer_len FROM docs_clean",
    "a4_report": f"""{_VAL},
      agg AS (SELECT count(*) FILTER (WHERE ok)::BIGINT AS total_raw,
                     count(*) FILTER (WHERE reason IS NULL)::BIGINT AS total_clean,
                     count(*) FILTER (WHERE reason IS NOT NULL)::BIGINT AS dropped FROM validated)
      SELECT total_raw, total_clean, dropped,
        (SELECT count(*) FROM (SELECT domain FROM clean GROUP BY domain))::BIGINT AS n_domains,
        (SELECT CAST(round_even(coalesce(avg(length(question)), 0), 0) AS BIGINT) FROM clean) AS avg_question_len,
        (SELECT CAST(round_even(coalesce(avg(length(answer)), 0), 0) AS BIGINT) FROM clean) AS avg_answer_len
      FROM agg""",
    "p1_chat_profile": f"{with_(PAIRS)} SELECT rid, {chat_text(PR.PROFILE_SYSTEM_PROMPT)} AS text FROM pairs",
    "p2_plain": f"{with_(PAIRS)} SELECT rid, {lit(PR.PLAIN_PREFIX_Q)} || question || {lit(PR.PLAIN_PREFIX_A)} || answer "
                f"AS text FROM pairs",
    "p3_chat_train": f"{with_(PAIRS)} SELECT rid, {chat_text(PR.TRAIN_SYSTEM_PROMPT)} AS text FROM pairs",
    "p4_infer": f"{with_(PAIRS)} SELECT rid, {lit(PR.INFER_PREFIX)} || question || {lit(PR.INFER_SUFFIX)} AS prompt "
                f"FROM pairs",
    "p5_strip": f"SELECT doc_id AS rid, {trim('text')} AS completion FROM documents",
    "t1_tokens": f"{with_(PAIRS, lengths_cte('pairs'))} SELECT rid, n_tokens FROM lens",
    "t2_overlimit": f"{with_(PAIRS, lengths_cte('pairs'))} SELECT rid, n_tokens, n_tokens > 512 AS over_limit FROM lens",
    "t3_report": with_(PAIRS) + "," + report_sql(lengths_cte("pairs")),
    "t3_doc_report": with_(DOCS) + "," + report_sql(lengths_cte("docs_clean")),
    "t4_p95": with_(PAIRS) + "," + p95_sql(lengths_cte("pairs")),
    "t4_doc_answer_p95": with_(DOCS) + "," + p95_sql(f"lens AS (SELECT rid, {word_count('answer')} AS n_tokens "
                                                      f"FROM docs_clean)"),
    "d1_shuffle": f"{with_(PAIRS, positions())} SELECT rid, pos FROM pos",
    "d2_split": f"{with_(PAIRS, positions(), SPLIT)} SELECT rid, pos, split FROM split",
    "d3_sizes": f"""{with_(PAIRS)}, c AS (SELECT count(*) AS n FROM pairs)
      SELECT 'train' AS split, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n FROM c
      UNION ALL SELECT 'val', CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) FROM c
      UNION ALL SELECT 'test', CAST(n - floor(n * CAST(0.8 AS DOUBLE)) - floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) FROM c""",
    "d4_trainval": f"""{with_(PAIRS, positions(':train_test_split'))}
      SELECT rid, pos, CASE WHEN pos < ceil(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM pos""",
    "d5_head": f"{with_(PAIRS, positions(), SPLIT)} SELECT rid, pos FROM split WHERE split = 'test' ORDER BY pos LIMIT 100",
    "e1_predict": f"{with_(PAIRS)} SELECT rid, 'stub' AS label, "
                  f"{trim(FIRST_SENTENCE)} AS prediction FROM pairs",
    "e2_pairs": f"{_E2} SELECT label, rid, prediction, reference FROM e2",
    "e3_bleu": f"""{_SCORE}, {BLEU}
      SELECT label, round(geo * bpen, 6) AS bleu, round(bpen, 6) AS brevity_penalty,
        m1::BIGINT AS m1, m2::BIGINT AS m2, m3::BIGINT AS m3, m4::BIGINT AS m4,
        t1::BIGINT AS t1, t2::BIGINT AS t2, t3::BIGINT AS t3, t4::BIGINT AS t4,
        c::BIGINT AS pred_len, r::BIGINT AS ref_len FROM bleu""",
    "e4_rouge_n": f"{_SCORE}, {ROUGE_N} SELECT label, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM rn",
    "e5_rouge_l": f"{_SCORE}, {ROUGE_L} SELECT label, round(rougeL, 6) AS rougeL FROM rl",
    "e6_metrics": f"{METRICS4} SELECT label, bleu, rouge1, rouge2, rougeL FROM e6",
    "e6_doc_metrics": f"""{with_(DOCS, "pairs AS (SELECT rid, question, answer FROM docs_clean)", PREDS, TOKS)}, {BLEU}, {ROUGE_N}
      SELECT label, round(geo * bpen, 4) AS bleu, round(rouge1, 4) AS rouge1, round(rouge2, 4) AS rouge2 FROM bleu b JOIN rn USING (label)""",
    "e7_compare": f"""{METRICS4},
      lng AS (SELECT label, 'bleu' AS metric, bleu AS value FROM e6 UNION ALL SELECT label, 'rouge1', rouge1 FROM e6
              UNION ALL SELECT label, 'rouge2', rouge2 FROM e6 UNION ALL SELECT label, 'rougeL', rougeL FROM e6)
      SELECT b.metric, b.value AS base, f.value AS finetuned, round(f.value - b.value, 4) AS delta
      FROM lng b JOIN lng f ON b.metric = f.metric AND b.label = 'base' AND f.label = 'finetuned'""",
    "s1_file_lines": f"""WITH files AS (SELECT doc_id // 1024 AS file_no,
        unnest(string_split(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id), chr(10))) AS raw,
        generate_subscripts(string_split(string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id), chr(10)), 1) - 1 AS idx
        FROM documents GROUP BY doc_id // 1024)
      SELECT file_no, idx, {trim('raw')} AS line FROM files WHERE {trim('raw')} <> ''""",
    "s3_s6_roundtrip": f"{with_(DOCS)} SELECT rid, question, answer, CASE WHEN rid % 7 <> 0 THEN domain END AS domain FROM docs_clean",
    "s7_splits": f"""{with_(PAIRS, positions(), SPLIT)} SELECT rid, question, answer, CAST(NULL AS VARCHAR) AS domain, pos, split
      FROM split JOIN pairs USING (rid)""",
    "s8_metrics": f"""{METRICS4} SELECT label, 'bleu' AS metric, bleu AS value FROM e6 UNION ALL SELECT label, 'rouge1', rouge1 FROM e6
      UNION ALL SELECT label, 'rouge2', rouge2 FROM e6 UNION ALL SELECT label, 'rougeL', rougeL FROM e6""",
    "e4_rouge_bootstrap": f"""{_SCORE}, {ROUGE_N}, {ROUGE_L},
      f AS (SELECT label, rid, 'rouge' || n AS metric, CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END AS f FROM rf
        UNION ALL SELECT label, rid, 'rougeL', CASE WHEN m = 0 OR nn = 0 OR lcs = 0 THEN 0.0 ELSE 2.0 * (lcs / CAST(m AS DOUBLE)) * (lcs / CAST(nn AS DOUBLE))
          / (lcs / CAST(m AS DOUBLE) + lcs / CAST(nn AS DOUBLE)) END FROM lcs),
      x0 AS (SELECT rid, b, (CAST('0x' || substr(md5(CAST(rid AS VARCHAR) || ':42'), 1, 15) AS HUGEINT) + b * {STEP}::HUGEINT) & {MASK}::HUGEINT AS x
        FROM pairs CROSS JOIN range(1000) t(b)),
      x1 AS (SELECT rid, b, (xor(x, x >> 31) * {FIRST}::HUGEINT) & {MASK}::HUGEINT AS x FROM x0),
      x2 AS (SELECT rid, b, (xor(x, x >> 29) * {SECOND}::HUGEINT) & {MASK}::HUGEINT AS x FROM x1),
      w AS MATERIALIZED (SELECT rid, b, len(list_filter({POISSON}, lambda t: t <= u)) AS w FROM (SELECT rid, b, CAST(xor(x, x >> 31) >> 30 AS BIGINT) AS u FROM x2)),
      means AS (SELECT label, metric, b, sum(w * floor(f * 1000000000 + 0.5)) / sum(w) / 1000000000 AS mean FROM f JOIN w USING (rid) GROUP BY ALL HAVING sum(w) > 0)
      SELECT label, metric, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.5), 6) AS mid, round(quantile_cont(mean, 0.975), 6) AS high
      FROM means GROUP BY ALL""",
    "d1_dense_shuffle": f"{with_(DOCS, dense_positions())} SELECT rid, idx, pos, record FROM pos JOIN records USING (rid) JOIN numbered USING (rid)",
    "d2_dense_split": f"{with_(DOCS, dense_positions(), SPLIT)} SELECT rid, pos, split, record FROM split JOIN records USING (rid)",
    "d4_dense_trainval": f"""{with_(DOCS, dense_positions('train_test_split'))}
      SELECT rid, pos, CASE WHEN pos < ceil(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split, record FROM pos JOIN records USING (rid)""",
    "e2_stored_pairs": f"{_E2} SELECT label, rid, prediction, reference FROM e2",
    "p1_model_chat": f"""{with_(DOCS)}, m AS (SELECT rid, question AS q, answer AS a, {lit(PR.PROFILE_SYSTEM_PROMPT)} AS s, chr(10) AS n FROM docs_clean)
      SELECT rid, 'marked' AS template, '<|im_start|>system' || n || s || '<|im_end|>' || n || '<|im_start|>user' || n || q || '<|im_end|>' || n
        || '<|im_start|>assistant' || n || a || '<|im_end|>' || n AS text FROM m
      UNION ALL SELECT rid, 'headed', {chat_text(PR.PROFILE_SYSTEM_PROMPT)} FROM docs_clean
      UNION ALL SELECT rid, 'tagged', '<|system|>' || n || s || '</s>' || n || '<|user|>' || n || q || '</s>' || n || '<|assistant|>' || n || a || '</s>' || n FROM m""",
}

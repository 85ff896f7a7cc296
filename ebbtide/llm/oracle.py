"""SQL forms, for another engine, of those queries that SQL can express over whole tables."""

from __future__ import annotations

from ebbtide.llm import chat, mixing, url_filter

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\0')"
    for control, code in zip(chat.CONTROLS, chat._CODES):
        out = f"replace({out}, {_quoted(control)}, {_quoted(chr(92) + code)})"
    return out


def chat_sql() -> str:
    frame = len(chat.START + chat.ROLE + chat.ROLE_END + chat.END)
    hard = _quoted("</s>[INST] ok [/INST]")
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS given, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {hard} UNION ALL SELECT -7, 1, 'assistant', {hard}
), named AS (
  SELECT conv_id, turn, given, text,
         CASE given WHEN 'human' THEN 'user' WHEN 'prompter' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant'
                    WHEN 'model' THEN 'assistant' ELSE given END AS role
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, given, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, given, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({frame} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM named GROUP BY conv_id"""


LINES = f"""
WITH lines AS (
  SELECT doc_id, l.line AS line, l.place AS place,
         {_LOWER.format(f"trim(l.line, {_BLANKS})")} AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS place) l
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, place, shared.key IS NOT NULL AND keeper IS DISTINCT FROM doc_id AS gone
  FROM lines LEFT JOIN shared ON lines.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

EXACT = f"""
WITH n AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)"""


def _rule(of: int | None) -> str:
    cases = []
    for rule in url_filter._longest_first(url_filter.RULES):
        says = rule[0] + rule[1] if of is None else rule[of]
        cases.append(
            f"WHEN (host = '{rule[0]}' OR ends_with(host, '.{rule[0]}')) AND starts_with(path, '{rule[1]}') THEN '{says}'"
        )
    return f"CASE {' '.join(cases)} END"


def url_sql() -> str:
    def strength(level: str) -> str:
        return f"""(SELECT (1 - rho) / rho FROM (SELECT greatest({url_filter.LEAST_SPREAD}, least({url_filter.MOST_SPREAD}, coalesce(
          CASE WHEN n - nn / n - (c - 1) > 0 AND k > 0 AND k < n
               THEN ((kkn - k * (k / n)) / ((k / n) * (1 - k / n)) - (c - 1)) / (n - nn / n - (c - 1)) ELSE 0 END, 0))) AS rho
          FROM (SELECT CAST(sum(bad) AS DOUBLE) AS k, CAST(sum(labelled) AS DOUBLE) AS n, count(*) AS c,
                       sum(CAST(labelled AS DOUBLE) * labelled) AS nn, sum(CAST(bad AS DOUBLE) * bad / labelled) AS kkn
                FROM {level} WHERE labelled > 0)))"""

    after = "substr(url, strpos(url, '://') + 3)"
    return f"""
WITH placed AS (
  SELECT page_id,
         coalesce(CASE WHEN strpos(url, '://') > 0 THEN {_LOWER.format(f"regexp_extract({after}, '^[^/?#]*')")} ELSE '' END, '') AS host,
         coalesce(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract({after}, '^[^/?#]*([^?#]*)', 1) ELSE '' END, '') AS path
  FROM pages
), marks AS (SELECT doc_id, max(greatest(1 - quality, toxic)) AS bad FROM labels GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad,
         array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM placed LEFT JOIN marks ON page_id = doc_id GROUP BY host
), domains AS (SELECT domain, suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(labelled) AS labelled, sum(bad) AS bad FROM hosts GROUP BY suffix),
fit AS (
  SELECT (SELECT (sum(bad) + 1) / (sum(labelled) + 2) FROM hosts) AS mean,
         {strength('suffixes')} AS ss, {strength('domains')} AS sd, {strength('hosts')} AS sh
), s AS (SELECT suffix, (bad + ss * mean) / (labelled + ss) AS m FROM suffixes, fit),
d AS (SELECT domain, (bad + sd * s.m) / (labelled + sd) AS m FROM domains JOIN s USING (suffix), fit),
h AS (
  SELECT host, a / (a + b) - {url_filter.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound
  FROM (SELECT host, bad + sh * d.m AS a, labelled - bad + sh * (1 - d.m) AS b FROM hosts JOIN d USING (domain), fit)
)
SELECT page_id, host, path, {_rule(None)} AS rule,
       coalesce({_rule(2)}, CASE WHEN bound > {url_filter.BAD_SHARE} THEN 'block' ELSE 'allow' END) AS verdict
FROM placed JOIN h USING (host)"""


def mix_sql() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    most = mixing.MOST_COPIES
    offset = f"('0x' || substr(md5('{mixing.SEED}:' || coalesce('=' || source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {weights} END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM sized GROUP BY source)
), filled AS (
  SELECT *, (total - cap_before) / CAST(weights - w_before AS DOUBLE) AS level FROM (
    SELECT *, {most} * source_size AS cap, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
           coalesce(sum({most} * source_size) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before
    FROM sources WINDOW o AS (ORDER BY {most} * source_size / CAST(w AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), free AS (SELECT min(level) FILTER (level * w <= cap) AS any_level, first(level ORDER BY cap / CAST(w AS DOUBLE), source NULLS LAST) FILTER (level * w <= cap) AS level,
           min(cap / CAST(w AS DOUBLE)) FILTER (level * w <= cap) AS from_ratio FROM filled),
targets AS (
  SELECT source, source_size, n,
         CASE WHEN from_ratio IS NULL OR cap / CAST(w AS DOUBLE) < from_ratio THEN CAST(cap AS DOUBLE) ELSE free.level * w END AS target
  FROM filled, free
), ranked AS (
  SELECT doc_id, size, source_size, target, t.source,
         row_number() OVER (PARTITION BY t.source ORDER BY length(bin(size)),
           CAST('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % ((n - 1) // {mixing.BLOCK_ROWS} + 1),
           size, doc_id NULLS FIRST) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate, {offset} AS u FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(CAST(place AS DOUBLE) * rate + u) - floor((CAST(place AS DOUBLE) - 1) * rate + u)) AS BIGINT) AS taken
FROM rated"""


_TERMS = f"regexp_extract_all({_LOWER.format('coalesce(text, {0})')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format("''")

RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
total AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS nt FROM docs),
tf AS (SELECT r, doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM docs) GROUP BY ALL),
wanted AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
weighted AS (
  SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / CAST(2 * count(*) + 1 AS DOUBLE)))::BIGINT AS w FROM tf, total GROUP BY t
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nt))))::BIGINT AS score
  FROM tf JOIN weighted USING (t) JOIN wanted USING (t), total GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


#: CRC-32 (polynomial 0xEDB88320) of the bytes of a number's digits: each byte is followed by eight shifts, written -1.
_CRC = """xor(CAST(4294967295 AS BIGINT), list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)) END))"""

#: Pairs of neighbouring words that are equal q words apart, without a gap, are a stretch of period q; it is a run unless a stretch of a
#: smaller period has all of it.
RUNS = f"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, {_CRC} AS h FROM documents
), sized AS (SELECT *, len(ws) AS n, h // 10 AS g, h % 10 = 0 AND len(ws) > 0 AS changed FROM given),
placed AS (SELECT *, CASE WHEN changed THEN g % n ELSE 0 END AS a FROM sized),
period AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
words AS (
  SELECT r, i, CASE WHEN changed AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM period)
), pairs AS (SELECT r, i, w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY i) AS ww FROM words),
equal AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM pairs x JOIN pairs y ON x.r = y.r AND x.ww = y.ww AND y.i > x.i
  JOIN sized s ON s.r = x.r WHERE 4 * (y.i - x.i) <= s.n
), islands AS (
  SELECT r, q, min(i) AS start, count(*) + 1 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal) GROUP BY r, q, island
  HAVING count(*) + 1 + q >= greatest(6, 4 * q)
), runs AS (
  SELECT * FROM islands x WHERE NOT EXISTS (
    SELECT 1 FROM islands y WHERE y.r = x.r AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS place FROM runs
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM runs GROUP BY r
), kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM words WHERE NOT EXISTS (
    SELECT 1 FROM runs WHERE runs.r = words.r AND words.i >= runs.start + runs.q AND words.i < runs.start + runs.length) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM given LEFT JOIN listed USING (r) LEFT JOIN kept USING (r) LEFT JOIN ranked ON ranked.r = given.r AND place = 1"""


def all_sql() -> dict[str, str]:
    return {
        "op4_chat_formatting": chat_sql(), "op6_line_dedup": LINES, "op7_exact_dedup": EXACT,
        "op9_url_reputation": url_sql(), "op10_source_mix": mix_sql(), "op11_lexical_search": RANKED, "op12_periodic_runs": RUNS,
    }

"""SQL for the registered queries that it can express.

None for op1, op4, op5, op9 and the pipeline: SQL walks no automaton, learns no partitions and trains
no models.
"""

from __future__ import annotations

from exposcan.llm.licenses import BAND, BASE, COVERED, RUN, STRETCH, WORDINGS
from exposcan.llm.mixing import KEPT, POWERS, ROUNDS, SCALINGS
from exposcan.llm.urls import RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def words(pattern: str, lower: bool = True, text: str = "text") -> str:
    text = f"coalesce({text}, '')"
    return f"regexp_extract_all({f"translate({text}, '{UPPER}', '{LOWER}')" if lower else text}, {pattern})"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v).replace('"', "'") if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


LICENSES = f"""
WITH d AS (SELECT doc_id, {words(ALNUM)} AS ws FROM documents),
phrases(wording, label, exact, phrase) AS (VALUES {values([*((k, v, True, p) for k, (p, v) in enumerate(BASE.items())), *((k + 100, v, False, p) for k, (p, v) in enumerate(WORDINGS.items()))])}),
split AS (SELECT wording, label, exact, string_split(phrase, ' ') AS pw FROM phrases),
runs AS (
  SELECT wording, label, exact, len(pw) - {RUN - 1} AS runs, i - 1 AS place, array_to_string(pw[i:i + {RUN - 1}], ' ') AS run
  FROM split, unnest(range(1, len(pw) - {RUN - 2})) AS t(i)
),
grams AS (SELECT doc_id, i - 1 AS pos, array_to_string(ws[i:i + {RUN - 1}], ' ') AS run FROM d, unnest(range(1, len(ws) - {RUN - 2})) AS t(i)),
votes AS (
  SELECT doc_id, wording, label, exact, runs, pos - place AS diagonal, list(DISTINCT place) AS places
  FROM grams JOIN runs USING (run) GROUP BY ALL
),
opened AS (
  SELECT *, CASE WHEN exact OR lag(diagonal) OVER side IS NULL OR diagonal - lag(diagonal) OVER side > {BAND} THEN 1 ELSE 0 END AS opens
  FROM votes WINDOW side AS (PARTITION BY doc_id, wording ORDER BY diagonal)
),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, wording ORDER BY diagonal) AS span FROM opened),
spans AS (
  SELECT doc_id, wording, label, exact, runs, span, len(list_distinct(flatten(list(places)))) AS held,
         min(diagonal + list_min(places)) AS start, max(diagonal + list_max(places) + {RUN}) AS stop
  FROM numbered GROUP BY ALL
),
found AS (
  SELECT *, held / runs AS share FROM spans
  WHERE CASE WHEN exact THEN held = runs ELSE held / runs >= {COVERED} AND stop - start <= {STRETCH} * (runs + {RUN - 1}) END
),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(start) FILTER (WHERE exact) AS first_word, max(start) FILTER (WHERE exact) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per_doc USING (doc_id)
"""

URLS = rf"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
r(verdict, host, path) AS (VALUES {values(RULES)})
SELECT page_id, p.host AS host, p.path AS path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(arg_max(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY page_id, p.host, p.path
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words(SPACED)} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
  FROM d, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (
  SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(node, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON node = doc_id GROUP BY ALL
"""

MIX_TEXT = "coalesce(text, '')"


def _mixing() -> str:
    steps = [f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, lang, coalesce('=' || source, '') AS s, coalesce('=' || lang, '') AS l,
         CASE WHEN contains({MIX_TEXT}, 'icense') THEN 'legal' WHEN contains({MIX_TEXT}, '@') THEN 'contact'
              WHEN contains({MIX_TEXT}, ' | ') THEN 'table' ELSE 'prose' END AS topic, len({words(SPACED, lower=False)}) AS n_tokens
  FROM documents
),
f0 AS MATERIALIZED (SELECT s, l, topic, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE AS w FROM d GROUP BY s, l, topic HAVING sum(n_tokens) > 0)"""]
    column = {"source": "s", "lang": "l", "topic": "topic"}
    for name, power in POWERS.items():
        c = column[name]
        steps.append(f"goal_{c} AS MATERIALIZED (SELECT {c}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS goal FROM f0 GROUP BY {c})")
    pos = 0
    for _ in range(ROUNDS):
        for name in POWERS:
            c = column[name]
            steps.append(
                f"f{pos + 1} AS MATERIALIZED (SELECT s, l, topic, tokens, w * goal / sum(w) OVER (PARTITION BY {c}) AS w FROM f{pos} JOIN goal_{c} USING ({c}))"
            )
            pos += 1
    steps.append("c0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS c)")
    for k in range(SCALINGS):
        full = "w / tokens * c >= 1"
        steps.append(
            f"c{k + 1} AS MATERIALIZED (SELECT CASE WHEN coalesce(sum(CASE WHEN {full} THEN 0 ELSE w END), 0) = 0 THEN max(c) ELSE "
            f"({KEPT} * sum(tokens) - sum(CASE WHEN {full} THEN tokens ELSE 0 END)) / sum(CASE WHEN {full} THEN 0 ELSE w END) END AS c FROM f{pos}, c{k})"
        )
    steps.append(f"chance AS MATERIALIZED (SELECT s, l, topic, w, least(1.0, w / tokens * c) AS p FROM f{pos}, c{SCALINGS})")
    steps.append("""drawn AS (
  SELECT doc_id, source, lang, d.topic AS topic, n_tokens, round(coalesce(w, 0.0), 6)::DOUBLE AS cell_weight,
         round(CASE WHEN n_tokens > 0 THEN p ELSE 0.0 END, 6)::DOUBLE AS probability
  FROM d LEFT JOIN chance ON d.s = chance.s AND d.l = chance.l AND d.topic = chance.topic
)
SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|mix'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < probability AS kept FROM drawn""")
    return ",\n".join(steps[:-1]) + ",\n" + steps[-1]


def _masked(name: str, pos: str) -> str:
    masks = ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 2, 3, 6, 7))
    return " ".join(["CASE mask", *(f"WHEN {k} THEN concat_ws(' ', {', '.join(f'{name}[{pos} + {n + 1}]' for n in m)})" for k, m in enumerate(masks)), "END"])


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {words(ALNUM)} AS ws FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, {words(ALNUM)} AS iw FROM benchmark WHERE item_id IS NOT NULL),
masks AS (SELECT unnest([0, 1, 2]) AS mask),
seeds AS (SELECT item_id, place, mask, {_masked('iw', 'place')} AS run FROM b, unnest(range(0, len(iw) - 7)) AS t(place), masks),
grams AS (SELECT doc_id, pos, mask, {_masked('ws', 'pos')} AS run FROM d, unnest(range(0, len(ws) - 7)) AS t(pos), masks),
hits AS (SELECT DISTINCT doc_id, item_id, pos - place AS shift, place FROM grams JOIN seeds USING (run, mask)),
sized AS (SELECT *, least(13, len(iw)) AS size FROM hits JOIN b USING (item_id) JOIN d USING (doc_id)),
judged AS (
  SELECT doc_id, item_id, shift + s AS start, size AS n_window,
         len(list_filter(range(s, s + size), lambda j: shift + j >= 0 AND coalesce(ws[shift + j + 1] = iw[j + 1], false))) AS n_equal
  FROM sized, unnest(range(greatest(0, place + 8 - size), least(place, len(iw) - size) + 1)) AS t(s)
),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, start) AS rank FROM judged WHERE n_equal >= ceil(n_window * 0.8))
SELECT doc_id, item_id, start AS first_word, n_equal::BIGINT AS n_equal, n_window::BIGINT AS n_window FROM best WHERE rank = 1
"""

REPEATS = f"""
WITH d AS (SELECT doc_id, {words(SPACED, lower=False)} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(ws) - 11)) AS t(i)),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
hit AS (SELECT DISTINCT doc_id, i + j AS pos FROM g JOIN f USING (k), unnest(range(0, 13)) AS t(j) WHERE first < doc_id),
w AS (SELECT doc_id, ws[i] AS word, i AS pos FROM d, unnest(range(1, len(ws) + 1)) AS t(i)),
left_ AS (
  SELECT doc_id, count(hit.pos) AS n_removed, string_agg(CASE WHEN hit.pos IS NULL THEN word END, ' ' ORDER BY w.pos) AS kept
  FROM w LEFT JOIN hit USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_ USING (doc_id)
"""

#: Unsigned CRC-32 of a short ASCII text, bit by bit.
CRC = """
xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))
"""


def crc(doc_id: str = "doc_id") -> str:
    return CRC.format(f"{doc_id}::VARCHAR")


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


#: Levels of each tree in the SQL: enough for 16^8 leaves.
LEVELS = 8


def _manifest() -> str:
    """Level by level: ``c`` are the nodes of a tree with their run (all digests) where it has several nodes."""
    tampered = f"CASE WHEN {crc()} % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    steps = [f"""
WITH found AS (SELECT *, {tampered} AS now FROM documents),
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS leaf, {_leaf('now')} AS current,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {_leaf('text')}) - 1 AS pos
  FROM found
),
t0 AS MATERIALIZED (SELECT tree, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves)"""]

    def levels(name: str):
        for k in range(LEVELS):
            steps.append(f"{name}r{k} AS MATERIALIZED (SELECT tree, idx // 16 AS run, any_value(n) AS n, list(digest ORDER BY idx) AS members FROM {name}{k} GROUP BY ALL)")
            steps.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT tree, run AS idx, CASE WHEN n > 1 THEN sha256(array_to_string(members, '')) ELSE members[1] END AS digest, (n + 15) // 16 AS n FROM {name}r{k}
)""")

    def climb(rows: str, name: str, label: str):
        for k in range(LEVELS):
            steps.append(f"""{label}{k + 1} AS MATERIALIZED (
  SELECT x.* EXCLUDE (pos, cur, proof), pos // 16 AS pos,
         CASE WHEN r.n > 1 THEN sha256(array_to_string(members[:pos % 16], '') || cur || array_to_string(members[pos % 16 + 2:], '')) ELSE cur END AS cur,
         CASE WHEN r.n > 1 THEN proof || array_to_string(members[:pos % 16], '') || array_to_string(members[pos % 16 + 2:], '') ELSE proof END AS proof
  FROM {rows if k == 0 else f"{label}{k}"} x JOIN {name}r{k} r ON r.tree = x.tree AND r.run = x.pos // 16
)""")

    levels("t")
    steps.append(f"u0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, digest, count(*) OVER () AS n, tree AS of_tree FROM t{LEVELS})")
    levels("u")
    steps.append("start AS MATERIALIZED (SELECT doc_id, leaf, tree, pos, current AS cur, '' AS proof FROM leaves)")
    climb("start", "t", "a")
    steps.append(f"""middle AS MATERIALIZED (
  SELECT a.doc_id, a.leaf, '' AS tree, u0.idx AS pos, a.cur, a.proof, u0.digest AS subroot FROM a{LEVELS} a JOIN u0 ON u0.of_tree = a.tree
)""")
    climb("middle", "u", "b")
    return ",\n".join(steps) + f"""
SELECT b.doc_id, b.leaf, b.subroot, u.digest AS root, sha256(b.proof) AS proof_sha256, b.cur AS folded_root, b.cur = u.digest AS verified
FROM b{LEVELS} b, u{LEVELS} u
"""


#: Levels of doubling in the SQL: periods up to 2^14.
DOUBLINGS = 14


def _periodic() -> str:
    """Ranks of factors of 2^k words by doubling; where the next equal factor is at most 2^k on, that is the period."""
    steps = [f"""
WITH d AS (SELECT doc_id, {words(SPACED, lower=False)} AS ws, {crc()} AS h FROM documents),
sized AS (SELECT *, len(ws) AS n, h // 10 AS g FROM d),
aimed AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
aimed_p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM aimed),
w AS MATERIALIZED (
  SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS word
  FROM aimed_p, unnest(range(0, n)) AS t(i)
),
r0 AS MATERIALIZED (SELECT doc_id, i, dense_rank() OVER (ORDER BY word) AS r FROM w)"""]
    for k in range(DOUBLINGS):
        steps.append(f"""s{k} AS MATERIALIZED (
  SELECT doc_id, d, min(i) AS start, max(i) - min(i) + d + {1 << k} AS length
  FROM (
    SELECT doc_id, i, d, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, r ORDER BY i) - i AS d FROM r{k} WHERE r IS NOT NULL)
    WHERE d <= {1 << k} AND d > {(1 << k) // 2}
  ) GROUP BY doc_id, d, island
)""")
        steps.append(f"""p{k} AS (SELECT doc_id, i, r, lead(r, {1 << k}) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM r{k}),
r{k + 1} AS MATERIALIZED (SELECT doc_id, i, CASE WHEN later IS NOT NULL AND r IS NOT NULL THEN dense_rank() OVER (ORDER BY r, later) END AS r FROM p{k})""")
    every = " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(DOUBLINGS))
    steps.append(f"runs AS MATERIALIZED (SELECT doc_id, start, length, d AS period FROM ({every}) WHERE length >= greatest(6, 4 * d))")
    steps.append("""best AS (
  SELECT a.* FROM runs a ANTI JOIN runs b ON a.doc_id = b.doc_id AND (b.length * a.period > a.length * b.period
    OR (b.length * a.period = a.length * b.period AND (b.start < a.start OR (b.start = a.start AND b.period < a.period))))
),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, i FROM runs, unnest(range(start + period, start + length)) AS t(i)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)""")
    return ",\n".join(steps) + """
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


ORACLE: dict[str, str] = {
    "op2_license_scan": LICENSES,
    "op3_url_filter": URLS,
    "op6_jaccard_groups": JACCARD,
    "op7_mixing": _mixing(),
    "op8_decontamination": DECONTAMINATION,
    "op10_substring_dedup": REPEATS,
    "op11_periodic_runs": _periodic(),
    "op12_merkle_manifest": _manifest(),
}

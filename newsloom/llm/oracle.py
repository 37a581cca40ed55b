"""SQL for the checks of the native operators on another engine."""

from __future__ import annotations

from newsloom.llm.decontamination import LEAST_WORDS, UNITS, WINDOW
from newsloom.llm.pii import CONTEXT_CHARS, CONTEXT_WORDS, DISCLOSURE, KINDS, LEAST_CONTEXTS

# The patterns in their plain form.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def template_tokens(text: str) -> str:
    marked = f"regexp_replace({text}, '[0-9]+([.,][0-9]+)*', ' 0 ', 'g')"
    units = "|".join(UNITS)
    marked = rf"regexp_replace({marked}, '(?i)( 0 )\s*({units})([^\p{{L}}]|$)', '\1 2 \3', 'g')"
    marked = rf"regexp_replace({marked}, '([\p{{Ll}},;:]\s)(\p{{Lu}}\p{{L}}*)', '\1 1 ', 'g')"
    return rf"list_filter(string_split_regex(lower({marked}), '[^\p{{L}}012]+'), lambda t: t <> '')"


def template_windows(source: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, w FROM (SELECT {key}, unnest(list_transform(
      range(0, greatest(len(ts) - {WINDOW}, 0) + 1), lambda i: ts[i + 1 : i + {WINDOW}])) AS w
    FROM (SELECT {key}, {template_tokens("coalesce(text, '')")} AS ts FROM {source}) WHERE len(ts) > 0)
  WHERE len(list_filter(w, lambda x: x NOT IN ('0', '1', '2'))) >= {LEAST_WORDS}"""


# No item of the tables has a number, unit or name inside, so that slots cannot disagree.
LEAKS = f"""WITH dw AS MATERIALIZED ({template_windows('documents', 'doc_id')}),
bw AS MATERIALIZED ({template_windows('benchmark', 'item_id')}),
sizes AS (SELECT item_id, count(*) AS n FROM bw GROUP BY item_id),
found AS (SELECT doc_id, item_id, count(*) / any_value(n) AS coverage
  FROM dw JOIN bw USING (w) JOIN sizes USING (item_id) GROUP BY doc_id, item_id HAVING count(*) / any_value(n) >= 0.8),
best AS (SELECT doc_id, string_agg(item_id, ',' ORDER BY item_id) AS leaked_items, max(coverage) AS coverage
  FROM found GROUP BY doc_id)
SELECT doc_id, leaked_items IS NOT NULL AS contaminated, coalesce(leaked_items, '') AS leaked_items,
  coalesce(coverage, 0.0)::DOUBLE AS coverage FROM documents LEFT JOIN best USING (doc_id)"""


def digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '', 'g')"


VALID = {
    "email": "true",
    "ip": """list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) <= 3
      AND coalesce(try_cast(nullif(ltrim(p, '0'), '') AS INT), 0) <= 255))""",
    "card": f"""length({digits('value')}) BETWEEN 13 AND 19 AND list_sum(list_transform(
      range(length({digits('value')})), lambda i: CASE WHEN i % 2 = 0 THEN reverse({digits('value')})[i + 1]::INT
        ELSE 2 * reverse({digits('value')})[i + 1]::INT
          - CASE WHEN reverse({digits('value')})[i + 1]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0""",
    "phone": f"length({digits('value')}) BETWEEN 9 AND 15",
}


def located(source: str, pattern: str, kind: str, place: int) -> str:
    """`(doc_id, place, kind, start, stop, value)` of all matches: what lies between them gives their offsets."""
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, start, start + length(value) AS stop, value FROM (
    SELECT doc_id, ms[i] AS value,
      list_sum(list_transform(gaps[1 : i], lambda g: length(g)))::BIGINT
        + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda m: length(m))), 0)::BIGINT AS start
    FROM (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps
      FROM {source})))"""


def words(text: str) -> str:
    return rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}]+'), lambda t: t <> '')"


BASE = " UNION ALL ".join(
    f"SELECT * FROM ({located('docs', PATTERNS[kind], kind, place)}) WHERE {VALID[kind]}" for place, kind in enumerate(KINDS)
)

SPANS = rf"""WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS MATERIALIZED ({BASE}),
near AS (SELECT doc_id, kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN {digits('value')} ELSE lower(value) END AS entity,
    list_reverse(list_reverse({words(f"substring(text, greatest(start - {CONTEXT_CHARS}, 0) + 1, start - greatest(start - {CONTEXT_CHARS}, 0))")})[1 : {CONTEXT_WORDS}]) AS l,
    {words(f"substring(text, stop + 1, {CONTEXT_CHARS})")}[1 : {CONTEXT_WORDS}] AS r
  FROM base JOIN docs USING (doc_id)),
beside AS MATERIALIZED (SELECT doc_id, entity, (l, r) AS context, unnest(list_distinct(list_concat(l, r))) AS term FROM near),
pairs AS (SELECT entity, term, sum(n) AS together FROM (
    SELECT entity, term, context, count(DISTINCT doc_id) AS n FROM beside GROUP BY ALL)
  GROUP BY entity, term HAVING count(*) >= {LEAST_CONTEXTS}),
holds AS (SELECT doc_id, unnest(list_distinct({words('text')})) AS term FROM docs),
with_term AS (SELECT term, count(*) AS t FROM holds SEMI JOIN pairs USING (term) GROUP BY term),
with_entity AS (SELECT entity, count(DISTINCT doc_id) AS e FROM beside GROUP BY entity),
disclosing AS (SELECT DISTINCT term FROM pairs JOIN with_term USING (term) JOIN with_entity USING (entity),
    (SELECT count(*)::DOUBLE AS total FROM docs)
  WHERE e < total AND ln(total * together / (t * e)) >= {DISCLOSURE} * -ln(e / total)),
held AS (SELECT * FROM docs SEMI JOIN base USING (doc_id)),
terms AS (SELECT w.* FROM ({located('held', r'[\p{L}]+', 'term', len(KINDS))}) w
  SEMI JOIN disclosing ON lower(w.value) = disclosing.term
  ANTI JOIN base ON base.doc_id = w.doc_id AND w.start < base.stop AND base.start < w.stop),
shown AS (SELECT *, kind || ':' || start || ':' || stop AS s FROM (SELECT * FROM base UNION ALL SELECT * FROM terms))
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in KINDS)},
  sha256(coalesce(string_agg(s, ',' ORDER BY place, start) FILTER (kind <> 'term'), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY place, start), '') AS spans
FROM docs LEFT JOIN shown USING (doc_id) GROUP BY doc_id"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: a byte at a time, eight shifts each."""
    shifts = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ord(substring({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {shifts}), 4294967295)"


def field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Levels of eight that the statement can build: enough for eight million leaves of a language, and for 64 languages.
LANGUAGE_LEVELS, TOP_LEVELS = 8, 2


def _manifest() -> str:
    """Every level as a table `(tree, ordinal, size, digest, run)`, and then every leaf through all levels."""
    parts = [f"""leaves AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf,
    CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS claimed,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS ordinal,
    count(*) OVER (PARTITION BY lang) AS size FROM documents)"""]

    def climb(name: str, first: str, levels: int) -> None:
        parts.append(f"{name}0 AS MATERIALIZED ({first})")
        for i in range(levels):
            parts.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT tree, ordinal // 8 AS ordinal, (max(size) + 7) // 8 AS size,
    CASE WHEN max(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY ordinal)) END AS digest,
    CASE WHEN max(size) = 1 THEN '' ELSE string_agg(digest, '' ORDER BY ordinal) END AS run
    FROM {name}{i} GROUP BY tree, ordinal // 8)""")

    climb("low", "SELECT tree, ordinal, size, leaf AS digest FROM leaves", LANGUAGE_LEVELS)
    climb("top", f"SELECT 0 AS tree, tree AS ordinal, count(*) OVER () AS size, digest FROM low{LANGUAGE_LEVELS}", TOP_LEVELS)
    parts.append("path0 AS (SELECT doc_id, tree, ordinal, leaf, claimed AS folded, '' AS proof FROM leaves)")
    steps = [("low", i + 1, "path.tree", "path.ordinal", i) for i in range(LANGUAGE_LEVELS)]
    steps += [("top", i + 1, "0", "path.tree", i) for i in range(TOP_LEVELS)]
    for number, (name, level, tree, ordinal, below) in enumerate(steps):
        place = f"({ordinal} // {8 ** below} % 8)"
        left, right = f"substring(run, 1, {place} * 64)", f"substring(run, {place} * 64 + 65)"
        parts.append(f"""path{number + 1} AS (SELECT doc_id, path.tree, path.ordinal, leaf,
    CASE WHEN run = '' THEN folded ELSE sha256({left} || folded || {right}) END AS folded, proof || {left} || {right} AS proof
    FROM path{number} path JOIN {name}{level} up ON up.tree = {tree} AND up.ordinal = {ordinal} // {8 ** level})""")
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = r.digest AS verified
FROM path{len(steps)} p JOIN low{LANGUAGE_LEVELS} s USING (tree), top{TOP_LEVELS} r"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MANIFEST = _manifest()

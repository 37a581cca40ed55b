"""SQL pieces for the check of each query on another engine."""

from __future__ import annotations

from newsloom.operators.labels import CATEGORIES, NO_CATEGORY

# The character classes of the cleaning rules, as one list.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"[\p{L}\p{N}_]"

SEED = 42
TOKENS = 128

DOCUMENTS = "SELECT doc_id AS id, text, source, lang AS category FROM documents"
CODES = " ".join(f"WHEN {code} THEN '{name}'" for code, name in CATEGORIES.items())
CODED = f"""SELECT d.doc_id AS id, d.text, d.source,
  CASE l.quality + 2 * l.toxic {CODES} ELSE '{NO_CATEGORY}' END AS category
  FROM documents d LEFT JOIN labels l USING (doc_id)"""
NEWS = f"SELECT * FROM ({CODED}) WHERE category <> '{NO_CATEGORY}'"


def replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"


def urls(text: str) -> str:
    return replace(text, f"http[^{WS}]+")


def mentions(text: str) -> str:
    return replace(text, f"@{WORD}+")


def hashtags(text: str) -> str:
    return replace(text, f"#{WORD}+")


def letters(text: str) -> str:
    return replace(text, f"[^a-z{WS}]")


def collapse(text: str) -> str:
    return f"trim({replace(text, f'[{WS}]+', ' ')}, ' ')"


def clean(text: str) -> str:
    return collapse(letters(hashtags(mentions(urls(f"lower({text})")))))


def strip(text: str) -> str:
    return replace(text, f"^[{WS}]+|[{WS}]+$")


def fixed(value: str) -> str:
    """A number with six decimals."""
    return f"CAST(round({value}, 6) AS DECIMAL(9, 6))"


def labelled(source: str) -> str:
    """CTEs `arts` and `lmap` of a labelled source."""
    return f"""arts AS ({source}),
lmap AS (SELECT category, CAST(row_number() OVER (ORDER BY min(id), category) - 1 AS INTEGER) AS label_idx
  FROM arts WHERE category IS NOT NULL GROUP BY category)"""


def split(source: str, num: int = 1, den: int = 10) -> str:
    """CTE `parts`: encoded rows with `is_val`."""
    return f"""{labelled(source)},
shares AS (SELECT label_idx, category, count(*) AS n, count(*) * {num} // {den} AS base, count(*) * {num} % {den} AS rest
  FROM arts JOIN lmap USING (category) GROUP BY label_idx, category),
quota AS (SELECT label_idx, least(n - 1, base + CASE WHEN
    row_number() OVER (ORDER BY rest DESC, category) <=
      (sum(n) OVER () * {num} + {den - 1}) // {den} - sum(base) OVER () THEN 1 ELSE 0 END) AS q FROM shares),
parts AS (SELECT a.id, a.text, a.category, label_idx,
    row_number() OVER (PARTITION BY label_idx ORDER BY md5('{SEED}:' || a.id), a.id) <= q AS is_val
  FROM arts a JOIN lmap USING (category) JOIN quota USING (label_idx))"""


def model(source: str, smoothing: float = 1.0, vocabulary: int | None = None, most: int | None = None) -> str:
    """CTEs up to `weights` and `lstat`."""
    cut = f"[1:{most}]" if most else ""
    limit = f"ORDER BY n DESC, word LIMIT {vocabulary}" if vocabulary else ""
    return f"""{split(source)},
tok AS (SELECT id, label_idx, is_val, unnest(string_split(cleaned, ' '){cut}) AS word
  FROM (SELECT id, label_idx, is_val, {clean('text')} AS cleaned FROM parts) WHERE cleaned <> ''),
lw AS (SELECT label_idx, word, count(*) AS n FROM tok WHERE NOT is_val GROUP BY label_idx, word),
vocab AS (SELECT word, sum(n) AS n FROM lw GROUP BY word {limit}),
tokens AS (SELECT label_idx, sum(n) AS tokens FROM lw SEMI JOIN vocab USING (word) GROUP BY label_idx),
filled AS (SELECT label_idx, count(DISTINCT id) AS articles FROM tok WHERE NOT is_val GROUP BY label_idx),
lstat AS (SELECT category, label_idx, coalesce(articles, 0) AS articles, coalesce(tokens, 0) AS tokens,
    CAST(round(ln(CAST(articles AS DOUBLE) / sum(articles) OVER ()) * 1000000000) AS BIGINT) AS prior
  FROM lmap LEFT JOIN filled USING (label_idx) LEFT JOIN tokens USING (label_idx)),
weights AS (SELECT v.word, s.label_idx,
    CAST(round(ln((coalesce(lw.n, 0) + CAST({smoothing} AS DOUBLE))
      / (s.tokens + CAST({smoothing} AS DOUBLE) * (SELECT count(*) FROM vocab))) * 1000000000) AS BIGINT) AS weight
  FROM vocab v CROSS JOIN lstat s LEFT JOIN lw ON lw.word = v.word AND lw.label_idx = s.label_idx)"""


def scored(items: str, most: int | None = None) -> str:
    """CTEs `scores` and `probs` for items `(id, cleaned)`; follows `model`."""
    cut = f"[1:{most}]" if most else ""
    return f"""items AS ({items}),
itok AS (SELECT id, unnest(string_split(cleaned, ' '){cut}) AS word FROM items WHERE cleaned <> ''),
sums AS (SELECT id, label_idx, sum(weight) AS s FROM itok JOIN weights USING (word) GROUP BY id, label_idx),
scores AS (SELECT i.id, l.label_idx, l.category, CAST(l.prior + coalesce(s, 0) AS BIGINT) AS score
  FROM items i CROSS JOIN lstat l LEFT JOIN sums ON sums.id = i.id AND sums.label_idx = l.label_idx),
exps AS (SELECT *, exp(CAST(score - max(score) OVER (PARTITION BY id) AS DOUBLE) / 1000000000) AS e FROM scores),
probs AS (SELECT id, label_idx, category, score, e / sum(e) OVER (PARTITION BY id) AS p,
    row_number() OVER (PARTITION BY id ORDER BY score DESC, label_idx) AS place FROM exps)"""


def predictions(source: str, **settings) -> str:
    """CTE `preds` over the validation rows."""
    val = f"SELECT id, {clean('text')} AS cleaned FROM parts WHERE is_val"
    return f"""{model(source, **settings)}, {scored(val, settings.get('most'))},
preds AS (SELECT p.id, i.cleaned AS text, parts.label_idx AS true_label_idx, p.label_idx AS predicted_label_idx,
    parts.category AS true_category, p.category AS predicted_category
  FROM probs p JOIN items i USING (id) JOIN parts USING (id) WHERE place = 1)"""


def report(source: str) -> str:
    """CTE `rep`: counts and rates per class."""
    return f"""{predictions(source)},
base AS (SELECT l.label_idx, l.category,
    (SELECT count(*) FROM preds WHERE true_label_idx = l.label_idx) AS support,
    (SELECT count(*) FROM preds WHERE predicted_label_idx = l.label_idx) AS claimed,
    (SELECT count(*) FROM preds WHERE true_label_idx = l.label_idx AND predicted_label_idx = l.label_idx) AS hits
  FROM lmap l),
rep AS (SELECT *, coalesce(hits / nullif(CAST(claimed AS DOUBLE), 0), 0) AS precision,
    coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
    coalesce(2 * hits / nullif(CAST(support + claimed AS DOUBLE), 0), 0) AS f1 FROM base)"""


def results(source: str, raw: str) -> str:
    """CTEs `res` and `item_shares` for raw items `(id, text)`, whose ids may be NULL or repeated."""
    usable = f"SELECT row AS id, {clean('text')} AS cleaned FROM raw WHERE NOT {blank('text')}"
    return f"""raw AS MATERIALIZED (SELECT row_number() OVER () AS row, id, text FROM ({raw})),
{model(source)}, {scored(usable)},
maps AS (SELECT id, string_agg(category || ':' || {fixed('p')}, ',' ORDER BY category) AS probabilities
  FROM probs GROUP BY id),
res AS (SELECT raw.id, raw.text, coalesce(category, 'Invalid/Empty') AS predicted_category,
    coalesce(p, 0) AS confidence, coalesce(probabilities, '') AS probabilities
  FROM raw LEFT JOIN (SELECT * FROM probs WHERE place = 1) b ON b.id = raw.row LEFT JOIN maps ON maps.id = raw.row),
item_shares AS (SELECT raw.id, category, p FROM raw JOIN probs ON probs.id = raw.row)"""


def blank(text: str) -> str:
    return f"({text} IS NULL OR NOT regexp_matches({text}, '[^{WS}]'))"


def losses(source: str, temperatures: list[float]) -> str:
    """CTEs `away` (distance of each score from the best), `losses` per temperature and `best`, over the validation rows."""
    val = f"SELECT id, {clean('text')} AS cleaned FROM parts WHERE is_val"
    choices = ", ".join(f"({t!r}::DOUBLE)" for t in temperatures)
    return f"""{model(source)}, {scored(val)},
away AS (SELECT id, s.label_idx, (score - max(score) OVER (PARTITION BY id))::DOUBLE / 1000000000 AS a,
    s.label_idx = parts.label_idx AS own FROM scores s JOIN parts USING (id)),
choices(temperature) AS (VALUES {choices}),
single AS (SELECT temperature, id, ln(sum(exp(a / temperature))) - sum(a) FILTER (own) / temperature AS loss
  FROM away CROSS JOIN choices GROUP BY temperature, id),
losses AS (SELECT temperature, count(loss) AS rows, avg(loss) AS loss FROM single GROUP BY temperature),
best AS (SELECT temperature FROM losses ORDER BY round(loss, 9), temperature LIMIT 1)"""


def calibrated(source: str, temperatures: list[float]) -> str:
    """CTE `warm`: probabilities at the best temperature and at 1, with whether the likeliest class is right."""
    return f"""{losses(source, temperatures)},
warm AS (SELECT t.temperature, id, label_idx, own, exp(a / t.temperature)
      / sum(exp(a / t.temperature)) OVER (PARTITION BY t.temperature, id) AS p,
    row_number() OVER (PARTITION BY t.temperature, id ORDER BY a DESC, label_idx) AS place
  FROM away CROSS JOIN (SELECT temperature FROM best UNION SELECT 1::DOUBLE) t)"""

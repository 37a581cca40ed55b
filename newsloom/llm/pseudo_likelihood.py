"""LM scoring by masked pseudo-likelihood with a bidirectional window network in numpy.

Every token is predicted from its neighbours on both sides: position-wise
embeddings of the window are summed, a hyperbolic tangent follows, and a softmax runs
over classes of words. A document's score is the sum of the log-probabilities of
all its tokens, each given all its neighbours: P(class | both sides) x P(word | class).

Classes and the words inside them come from word counts over the whole corpus: the most
frequent words are classes of their own, all others share classes by word ending. P(word | class)
is the word's share of its class; one more count in each class is kept for words the corpus has not.
Texts are cut at white space, and each different piece is taken apart into words once, not wherever it stands.
Words up to a bounded number, the most frequent, are weighed where the texts stand; the
others, counted per row, in a join with the whole table. Training deals the tokens of
every document to masks, and every round takes masks of its own, so that the rounds together
predict every token of the corpus once; each task takes steps from the same start on its own
rows, and the mean of the networks, weighted by tokens, starts the next round.
What is counted, masked and averaged grows with the corpus; a network does not.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import small_batches
from newsloom.staging import bounded_rows, stage

#: Softmax classes: frequent words, endings of other words, and the edge of a text.
WORDS = 192
ENDINGS = 63
EDGE = WORDS + ENDINGS
SIZE = EDGE + 1
#: Words whose weights go to all tasks, at most; the others are joined.
HEADS = 200_000
#: Neighbours on each side.
SIDE = 2
DIMENSIONS = 24
#: Masks to which tokens are dealt; the rounds share all of them.
MASKED = 16
ROUNDS = 2
RATE = 0.2
#: Tokens of a task's first steps; after every `STEPS_OF_SIZE` steps a step takes twice as many, up to `LARGEST_BATCH`,
#: which is also how many are scored at once.
BATCH = 256
LARGEST_BATCH = 2_048
STEPS_OF_SIZE = 16
#: Texts are split together up to so many characters, and scored together up to so many tokens.
CHARACTERS = 4_000_000
TOKENS = 200_000
#: Pieces of texts whose words a worker keeps, before it begins anew.
PIECES = 500_000
#: Scores up to this size are raised to powers as they are; larger ones have their largest taken off first.
SAFE = 60.0

TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


@dataclass(frozen=True)
class Network:
    words: dict[str, int]
    #: One table per neighbour, then the output weights and their bias.
    tables: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    inside: Inside | None = None


@dataclass(frozen=True)
class Inside:
    """P(word | class) of all words: the staged `(word, place, n)` of a corpus, and the counts of shared classes."""

    counts: DataFrame
    totals: dict[int, int]
    #: Class and log-probability of the most frequent words.
    heads: dict[str, tuple[int, float]]


def bucket(word: str) -> int:
    """The class that words with the same ending share."""
    return ending_class(word[-3:])


@lru_cache(maxsize=100_000)
def ending_class(ending: str) -> int:
    return WORDS + xxhash.xxh3_64_intdigest(ending.encode("utf-8", "surrogatepass")) % ENDINGS


def tokens_of(piece: str) -> list[str]:
    """The tokens of a text without ASCII white space; most are one word, or one word and a mark."""
    if piece.isalnum():
        return [piece]
    word, mark = piece[:-1], piece[-1:]
    if word.isalnum() and not mark.isspace():
        return [word, mark]
    return TOKEN.findall(piece)


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Start and end of runs of neighbouring rows that together have at most the given size, or are one row."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def split(texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts in lower case, cut at ASCII white space, which no token has inside: the different pieces, which of them stands
    at each place of the texts one after another, and where each text's places begin, and end."""
    found = pc.ascii_split_whitespace(pa.array([(text or "").lower() for text in texts], pa.large_string()))
    coded = found.values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), found.offsets.to_numpy()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`(word, place, n)` over all whole texts, `place` by ending. Pieces between white space are counted first, and every
    different piece is taken apart into words once."""

    def count_pieces(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column(0).to_pylist()
            for start, end in runs([len(text or "") for text in texts], CHARACTERS):
                different, places, _ = split(texts[start:end])
                times = np.bincount(places, minlength=len(different))
                yield pa.RecordBatch.from_arrays([different.cast(pa.string()), pa.array(times, pa.int64())], ["piece", "n"])

    def count_words(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            seen: defaultdict[str, int] = defaultdict(int)
            for piece, n in zip(*(column.to_numpy(zero_copy_only=False) for column in batch.columns), strict=True):
                for word in tokens_of(piece):
                    seen[word] += n
            places = pa.array([bucket(word) for word in seen], pa.int32())
            columns = [pa.array(list(seen), pa.string()), places, pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "place", "n"])

    pieces = small_batches(docs).select(F.col(text_col).cast("string")).mapInArrow(count_pieces, "piece string, n long")
    pieces = pieces.groupBy("piece").agg(F.sum("n").alias("n"))
    counted = pieces.mapInArrow(count_words, "word string, place int, n long")
    return counted.groupBy("word", "place").agg(F.sum("n").alias("n"))


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """`values`, with zeros put behind them if they are fewer than `size`; room grows by doubling."""
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), dtype=values.dtype)])


class Encoder:
    """Texts to class numbers and the log-probabilities of the words in their classes.

    What it learns of the pieces of texts it keeps for later texts, and leaves behind when it is sent to workers.
    """

    def __init__(self, words: dict[str, int], heads: dict[str, tuple[int, float]] | None = None):
        known = {word: (place, 0.0) for word, place in words.items()}
        known = {**(heads or {}), **known}
        places = np.array([place for place, _ in known.values()] or [0], dtype=np.uint8)
        weights = np.array([weight for _, weight in known.values()] or [0.0], dtype=np.float64)
        self.know(list(known), places, weights)

    def know(self, words: list[str], places: np.ndarray, weights: np.ndarray) -> None:
        self.index = {word: i for i, word in enumerate(words)}
        self.known_places, self.known_weights = places, weights
        self.forget()

    def __reduce__(self):
        return received, (list(self.index), self.known_places, self.known_weights)

    def forget(self) -> None:
        """Drop what is kept of pieces of texts; they are many where few words repeat."""
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        #: How many words each piece has, and where they begin among the words of all pieces.
        self.sizes, self.starts = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        #: The words of all pieces, their classes, log-probabilities there, and whether they are not known.
        self.words: list[str] = []
        self.classes, self.weights, self.other = np.zeros(0, dtype=np.uint8), np.zeros(0), np.zeros(0, dtype=bool)
        self.done = 0

    def learn(self) -> None:
        """Take in the pieces that came last."""
        words: list[str] = []
        sizes: list[int] = []
        for piece in islice(self.numbers, self.done, None):
            if piece.isalnum():
                words.append(piece)
                sizes.append(1)
            else:
                found = tokens_of(piece)
                words += found
                sizes.append(len(found))
        index = np.fromiter((self.index.get(word, -1) for word in words), np.int64, len(words))
        classes, weights, other = self.known_places[index], self.known_weights[index], index < 0
        weights[other] = 0.0
        for i in np.flatnonzero(other).tolist():
            classes[i] = bucket(words[i])
        start, end = len(self.words), len(self.words) + len(words)
        pieces = slice(self.done, self.done + len(sizes))
        self.sizes, self.starts = grown(self.sizes, pieces.stop), grown(self.starts, pieces.stop)
        self.sizes[pieces] = sizes
        self.starts[pieces] = start + np.cumsum(self.sizes[pieces]) - self.sizes[pieces]
        self.classes, self.weights, self.other = (grown(x, end) for x in (self.classes, self.weights, self.other))
        self.classes[start:end], self.weights[start:end], self.other[start:end] = classes, weights, other
        self.words += words
        self.done = pieces.stop

    def parts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, float, Counter]]:
        """For each whole text the classes of its tokens, with edges on both sides; the sum of the known weights; the other words."""
        for start, end in runs([len(text or "") for text in texts], CHARACTERS):
            yield from self.parts_of_run(texts[start:end])

    def parts_of_run(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, float, Counter]]:
        if self.done > PIECES:
            self.forget()
        different, places, bounds = split(texts)
        names = different.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))
        self.learn()
        # Every place of a piece becomes the places of its words.
        size = self.sizes[numbers][places]
        ends = np.append(0, np.cumsum(size))
        tokens = np.arange(ends[-1])
        word = tokens + np.repeat(self.starts[numbers][places] - ends[:-1], size)
        bounds = ends[bounds]
        text = np.repeat(np.arange(len(texts)), np.diff(bounds))
        codes = np.full(len(tokens) + 2 * SIDE * len(texts), EDGE, dtype=np.uint8)
        codes[tokens + (2 * SIDE * text + SIDE)] = self.classes[word]
        known = np.bincount(text, self.weights[word], len(texts)).tolist()
        rests: list[Counter] = [Counter() for _ in texts]
        others = np.flatnonzero(self.other[word])
        for i, k in zip(text[others].tolist(), word[others].tolist(), strict=True):
            rests[i][self.words[k]] += 1
        bounds = (bounds + 2 * SIDE * np.arange(len(texts) + 1)).tolist()
        for i, rest in enumerate(rests):
            yield codes[bounds[i] : bounds[i + 1]], known[i], rest

    def __call__(self, text: str | None) -> np.ndarray:
        """Classes of the tokens of a whole text, with edges on both sides."""
        return next(self.parts([text]))[0]


def received(words: list[str], places: np.ndarray, weights: np.ndarray) -> Encoder:
    encoder = Encoder({})
    encoder.know(words, places, weights)
    return encoder


def neighbours(codes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Classes around the given token places, one row per neighbour."""
    return np.stack([codes[places + i] for i in range(2 * SIDE + 1) if i != SIDE])


def hidden(around: np.ndarray, tables: np.ndarray) -> np.ndarray:
    total = np.take(tables[0], around[0], axis=0)
    for i in range(1, 2 * SIDE):
        total += np.take(tables[i], around[i], axis=0)
    return np.tanh(total, out=total)


def bounded(out: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no score of any class can leave the range that single precision raises to powers safely."""
    return bool((np.abs(out).sum(axis=0) + np.abs(bias)).max() <= SAFE)


def log_likelihood(codes: np.ndarray, network: Network) -> float:
    """Sum over all tokens of the log-probability given both sides."""
    return float(log_likelihoods([codes], network)[0])


def log_likelihoods(codes: list[np.ndarray], network: Network) -> np.ndarray:
    """`log_likelihood` of each text; short ones go through the network together."""
    counts = [len(c) - 2 * SIDE for c in codes]
    scores = [
        np.bincount(
            np.repeat(np.arange(end - start), counts[start:end]), token_scores(codes[start:end], network), end - start
        )
        for start, end in runs(counts, TOKENS)
    ]
    return np.concatenate(scores or [np.empty(0)])


def token_scores(codes: list[np.ndarray], network: Network) -> np.ndarray:
    """The log-probability of every token of the texts, one text after another, given both its sides."""
    counts = np.array([len(c) - 2 * SIDE for c in codes])
    joined = np.concatenate(codes)
    places = np.arange(counts.sum()) + np.repeat(2 * SIDE * np.arange(len(codes)) + SIDE, counts)
    safe, out = bounded(network.out, network.bias), with_bias(network.out, network.bias)
    ones, rows = np.ones(SIZE, dtype=np.float32), np.arange(LARGEST_BATCH)
    held = np.empty((LARGEST_BATCH, SIZE), dtype=np.float32)
    scores = np.empty(len(places), dtype=np.float32)
    for start in range(0, len(places), LARGEST_BATCH):
        near = places[start : start + LARGEST_BATCH]
        inner = with_ones(hidden(neighbours(joined, near - SIDE), network.tables))
        logits = np.matmul(inner, out, out=held[: len(near)])
        if not safe:
            logits -= logits.max(axis=1, keepdims=True)
        wanted = logits[rows[: len(near)], joined[near]]
        np.exp(logits, out=logits)
        scores[start : start + LARGEST_BATCH] = wanted - np.log(logits @ ones)
    return scores


def with_bias(out: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.concatenate([out, bias[None]])


def with_ones(inner: np.ndarray) -> np.ndarray:
    """`inner` with a last column that takes the bias."""
    wide = np.empty((len(inner), DIMENSIONS + 1), dtype=np.float32)
    wide[:, :DIMENSIONS] = inner
    wide[:, DIMENSIONS] = 1
    return wide


def step(network: tuple[np.ndarray, ...], seen: tuple[np.ndarray, ...], around: np.ndarray, wanted: np.ndarray) -> None:
    """One step on a batch, in place, with per-coordinate rates.

    A class's probability is its power over the row's total, so rows are divided by their totals where they
    are as wide as the network's inner layer, not where they are as wide as the classes.
    """
    tables, out, bias = network
    inner = hidden(around, tables)
    powers = with_ones(inner) @ with_bias(out, bias)
    if not bounded(out, bias):
        powers -= powers.max(axis=1, keepdims=True)
    np.exp(powers, out=powers)
    totals = powers @ np.ones(SIZE, dtype=np.float32)
    powers[np.arange(len(wanted)), wanted] -= totals
    scale = np.float32(1 / len(wanted)) / totals
    back = (powers @ out.T) * scale[:, None] * (1 - inner * inner)
    slopes_out = powers.T @ (inner * scale[:, None])
    slopes_bias = scale @ powers
    for i, slopes in enumerate(table_slopes(around, back)):
        descend(tables[i], seen[0][i], slopes)
    descend(out, seen[1], slopes_out.T)
    descend(bias, seen[2], slopes_bias)


def table_slopes(around: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Sums of the rows of `back` for each neighbour and class; two columns are added up at a time, as one complex number."""
    pairs = DIMENSIONS // 2
    cells = np.arange(SIZE * pairs, dtype=np.intp).reshape(SIZE, pairs)
    values = back.astype(np.float64).view(np.complex128).ravel()
    sums = np.zeros((2 * SIDE, SIZE * pairs), dtype=np.complex128)
    for i in range(2 * SIDE):
        np.add.at(sums[i], np.take(cells, around[i], axis=0).ravel(), values)
    return sums.view(np.float64).astype(np.float32).reshape(2 * SIDE, SIZE, DIMENSIONS)


def descend(weights: np.ndarray, seen: np.ndarray, slope: np.ndarray) -> None:
    seen += slope * slope
    weights -= np.float32(RATE) * slope / np.sqrt(seen)


def batch_size(taken: int) -> int:
    """Tokens of a task's next step after `taken` steps: small ones find the way, large ones cost less a token."""
    return min(LARGEST_BATCH, BATCH << min(taken // STEPS_OF_SIZE, 30))


def trained(codes: np.ndarray, turn: int, rounds: int, masked: int) -> np.ndarray:
    """Token places that a round predicts: those of its masks. Which mask a token gets depends on its text alone."""
    rng = np.random.default_rng(xxhash.xxh3_64_intdigest(codes.tobytes()))
    own = np.arange(masked) % rounds == turn
    return own.take(rng.integers(0, masked, len(codes) - 2 * SIDE)).nonzero()[0]


def fresh(words: dict[str, int]) -> Network:
    rng = np.random.default_rng(5)
    return Network(
        words,
        rng.normal(0, 0.1, (2 * SIDE, SIZE, DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.1, (DIMENSIONS, SIZE)).astype(np.float32),
        np.zeros(SIZE, dtype=np.float32),
    )


def vocabulary(docs: DataFrame, text_col: str = "text") -> tuple[dict[str, int], Inside]:
    """The `WORDS` most frequent words of all texts, ties by word, and the shares of all others in their classes."""
    counts = stage(word_counts(docs, text_col), "lm-words")
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS)
    words = {row.word: i for i, row in enumerate(bounded_rows(top, WORDS))}
    others = counts.filter(~F.col("word").isin(list(words))) if words else counts
    totals = {row.place: row.n for row in bounded_rows(others.groupBy("place").agg(F.sum("n").alias("n")), ENDINGS)}
    # The least power of two for which the words counted at least so often are few enough.
    tall = F.floor(F.log2("n")).cast("int")
    most, held = 64, 0
    for row in others.groupBy(tall.alias("power")).agg(F.count("*").alias("words")).orderBy(F.desc("power")).collect():
        held += row.words
        if held > HEADS:
            break
        most = row.power
    heads = {
        row.word: (row.place, math.log(row.n / (totals[row.place] + 1)))
        for row in bounded_rows(others.filter(tall >= most), HEADS)
    }
    return words, Inside(counts, totals, heads)


def counted_words(rests: list[Counter]) -> pa.Array:
    words = [word for rest in rests for word in rest]
    places = pa.array([bucket(word) for word in words], pa.int32())
    times = pa.array([n for rest in rests for n in rest.values()], pa.int64())
    each = pa.StructArray.from_arrays([pa.array(words, pa.string()), places, times], ["word", "place", "times"])
    ends = np.cumsum([0] + [len(rest) for rest in rests])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)


def encode(
    docs: DataFrame, words: dict[str, int], inside: Inside | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(row, doc_id, codes, inside, rest)` of all rows: a byte for each token of the whole text, and edges;
    the log-probabilities of known words in their classes, and the counts of the other words. Stage it: `row` is
    fixed when it is written."""
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(words, inside.heads if inside else {}))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in source:
            found = list(encoder.parts(batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([codes.tobytes() for codes, _, _ in found], pa.binary()),
                    pa.array([known for _, known, _ in found], pa.float64()),
                    counted_words([rest for _, _, rest in found]),
                ],
                names=["row", "doc_id", "codes", "inside", "rest"],
            )

    rows = small_batches(docs).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long"), F.col(text_col).cast("string")
    )
    return rows.mapInArrow(run, "row long, doc_id long, codes binary, inside double, rest array<struct<word:string,place:int,times:long>>")


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, masked: int = MASKED) -> Network:
    """Train on all tokens of every text, each in one round. Without tokens the network stays as it was drawn.

    Tasks step on their own rows, so weights depend on how rows are dealt to tasks, as the order of
    rows does in any stochastic training; counts, masks and the tokens trained on do not.
    """
    words, inside = vocabulary(docs, text_col)
    rows = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    return fit_codes(stage(encode(rows, words, inside), "lm-codes"), words, inside, rounds, masked)


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on all texts and score them; texts are turned into codes once."""
    words, inside = vocabulary(docs, text_col)
    coded = stage(encode(docs, words, inside, id_col, text_col), "lm-codes")
    return score_codes(coded, fit_codes(coded, words, inside))


def fit_codes(
    coded: DataFrame, words: dict[str, int], inside: Inside, rounds: int = ROUNDS, masked: int = MASKED
) -> Network:
    context = coded.sparkSession.sparkContext
    network = fresh(words)
    for turn in range(rounds):
        shared = context.broadcast(network)

        def train(source: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own = (start.tables.copy(), start.out.copy(), start.bias.copy())
            seen = tuple(np.full_like(x, 1e-4) for x in own)
            texts, places, held, taken, total = [], [], 0, 0, 0
            for batch in source:
                for raw in batch.column(0).to_pylist():
                    codes = np.frombuffer(raw, dtype=np.uint8)
                    tokens = len(codes) - 2 * SIDE
                    if tokens <= 0:
                        continue
                    texts.append(codes)
                    places.append(trained(codes, turn, rounds, masked))
                    held += len(places[-1])
                    if held >= batch_size(taken):
                        taken = steps(own, seen, texts, places, taken)
                        texts, places, total, held = [], [], total + held, 0
            if held:
                steps(own, seen, texts, places, taken)
                total += held
            if total:
                flat = np.concatenate([x.ravel() for x in own]).astype(np.float64) * total
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(len(flat) + 1), pa.int64()),
                        pa.array(np.append(flat, float(total)), pa.float64()),
                    ],
                    ["place", "value"],
                )

        def steps(own, seen, texts, places, taken: int) -> int:
            """Train on all tokens held; how many steps the task has taken then."""
            codes, starts = np.concatenate(texts), np.cumsum([0] + [len(text) for text in texts[:-1]])
            there = np.concatenate(places) + np.repeat(starts, [len(own_places) for own_places in places])
            x, y = neighbours(codes, there), codes[there + SIDE]
            start = 0
            while start < len(y):
                size = batch_size(taken)
                step(own, seen, x[:, start : start + size], y[start : start + size])
                start, taken = start + size, taken + 1
            return taken

        sums = (
            coded.select("codes")
            .mapInArrow(train, "place long, value double")
            .groupBy("place")
            .agg(F.sum("value").alias("value"))
            .toPandas()  # one row per parameter
        )
        if len(sums):
            flat = np.zeros(len(sums))
            flat[sums["place"].to_numpy()] = sums["value"].to_numpy()
            flat = (flat[:-1] / flat[-1]).astype(np.float32)
            parts = np.split(flat, np.cumsum([network.tables.size, network.out.size]))
            network = Network(
                network.words,
                parts[0].reshape(network.tables.shape),
                parts[1].reshape(network.out.shape),
                parts[2],
            )
        shared.unpersist()
    return replace(network, inside=inside)


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, n_tokens, log_likelihood, mean_log_likelihood)` for every row, over the whole text.

    NULL, empty and blank texts have no tokens, a sum of 0 and a NULL mean.
    Repeated rows are scored alike; a NULL id stays NULL; other columns are not read.
    """
    coded = encode(docs, network.words, network.inside, id_col, text_col)
    return score_codes(stage(coded, "lm-codes"), network)


def rest_weights(coded: DataFrame, inside: Inside) -> DataFrame:
    """`(row, more)`: the log-probabilities in their classes of words that were not known where the texts stand."""
    each = coded.select("row", F.inline("rest"))
    pairs = [F.lit(x) for pair in (inside.totals or {-1: 0}).items() for x in pair]
    total = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("place")), F.lit(0))
    # A word that the corpus has not gets the count kept for such words in its class.
    found = each.join(inside.counts.select("word", "n"), "word", "left")
    weight = F.ln(F.coalesce("n", F.lit(1)) / (total + 1))
    return found.groupBy("row").agg(F.sum(F.col("times") * weight).alias("more"))


def score_codes(coded: DataFrame, network: Network) -> DataFrame:
    inside = network.inside
    shared = coded.sparkSession.sparkContext.broadcast(replace(network, inside=None))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            codes = [np.frombuffer(raw, dtype=np.uint8) for raw in batch.column(2).to_pylist()]
            counts = [len(c) - 2 * SIDE for c in codes]
            sums = log_likelihoods(codes, shared.value) + batch.column(3).to_numpy()
            arrays = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(sums, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_tokens", "log_likelihood"])

    found = coded.drop("rest").mapInArrow(run, "row long, doc_id long, n_tokens long, log_likelihood double")
    if inside:
        more = rest_weights(coded, inside)
        found = found.join(more, "row", "left").withColumn(
            "log_likelihood", F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
        )
    found = found.select("doc_id", "n_tokens", "log_likelihood")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return found.withColumn("mean_log_likelihood", mean)

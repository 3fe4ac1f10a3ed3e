"""Language identification by a linear-chain conditional random field over words.

Words are runs of letter bytes (ASCII letters and all bytes of non-ASCII characters) of the
lower-cased text. A word's features are its affixes of one to three bytes, its two- and three-byte
grams with its borders, and, if it is in the lexicon of words seen at least `seen` times in training,
the word itself. Transition weights are learned from code-switched sequences spliced from training
documents of different languages. Forward-backward gives every word a distribution over the
languages; a document's language is the one with the most expected words, its score their share.

Training sees a sample of about `sample` documents a language (of the `most_labels` most frequent
ones) with `most_words` words at most, which bounds it whatever the input; it is fixed by hashes of
document ids. Languages share the words evenly, and a language's texts its share, so only the longest
texts are cut, and only for training. Predictions read whole texts and nothing but the text. Long texts are cut into blocks
whose transfer matrices are chained, which is exact.

Defined cases: a null text and one without a letter give `und` with score 0, as does a table with
nothing to learn from; ties go to the language that comes first by code point; repeated rows come out
alike; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, small_batches
from .suffixes import POWERS, TABLE, mix

UNKNOWN = "und"
GRAMS, LEXICON = 1 << 16, 1 << 16
BLOCK_WORDS, BATCH_BYTES, PART_BYTES = 128, 2 << 20, 1 << 19
#: Lanes whose gradients training works out at a time.
PART_LANES = 512
_LETTER = regex.compile(r"\p{L}")
_letters = np.zeros(256, np.uint8)
_letters[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_letters[128:] = np.arange(128, 256)
#: Bytes as features see them: letters as they are, all else 0.
LETTERS = _letters


def learnable() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull()


@dataclass
class Words:
    """Words of several texts: where their ranges begin and end in `data`, and how many each text has."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray


def words_of(texts: list[str]) -> Words:
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = LETTERS[np.frombuffer(b"\0" + b"\0".join(raw) + b"\0\0\0\0", np.uint8)]
    inside = data != 0
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    bounds = np.cumsum([0] + [len(r) + 1 for r in raw])
    return Words(data, start, end, np.diff(np.searchsorted(start, bounds, side="right")) if len(texts) else np.empty(0, np.int64))


def words_between(w: Words, begin: int, end: int) -> Words:
    """Words `begin` to `end` (exclusive, later) of `w`, as of one text, with no bytes but theirs and those beside them."""
    lo = w.start[begin] - 1
    return Words(w.data[lo : w.end[end - 1] + 4], w.start[begin:end] - lo, w.end[begin:end] - lo, np.array([end - begin]))


def word_hashes(w: Words) -> np.ndarray:
    up, down = POWERS.upto(len(w.data) + 1)
    prefix = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum(TABLE[w.data] * up[: len(w.data)], out=prefix[1:])
    return mix((prefix[w.end] - prefix[w.start]) * down[w.start])


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x = (a.astype(np.uint32) << 16 | b.astype(np.uint32) << 8 | c) * np.uint32(0x9E3779B1)
    return x >> np.uint32(16)


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray  # (2, GRAMS, labels): two- and three-byte grams
    affixes: np.ndarray  # (6, GRAMS, labels): prefixes of 1 to 3 bytes, suffixes of 1 to 3
    lexicon: np.ndarray  # (LEXICON + 1, labels): the last row is for words outside it
    known: np.ndarray  # bool, LEXICON
    moves: np.ndarray  # (labels, labels)

    def word_features(self, w: Words) -> list[np.ndarray]:
        d, s, e = w.data, w.start, w.end
        zero, last, two = np.uint8(0), d[e - 1], d[np.maximum(e - 2, 0)]
        h = (word_hashes(w) % np.uint64(LEXICON)).astype(np.int64)
        return [
            d[s].astype(np.int64), d[s].astype(np.int64) << 8 | d[s + 1], _triple(d[s], d[s + 1], np.where(d[s + 1] == 0, zero, d[s + 2])),
            last.astype(np.int64), two.astype(np.int64) << 8 | last, _triple(np.where(two == 0, zero, d[np.maximum(e - 3, 0)]), two, last),
            np.where(self.known[h], h, LEXICON),
        ]

    def gram_features(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        d = w.data
        return d[:-2].astype(np.int64) << 8 | d[1:-1], _triple(d[:-2], d[1:-1], d[2:])

    def scores(self, w: Words) -> np.ndarray:
        """(words, labels): summed weights of each word's features."""
        if not len(w.start):
            return np.zeros((0, len(self.labels)), np.float32)
        two, three = self.gram_features(w)
        each = self.grams[0][two] + self.grams[1][three]
        out = np.add.reduceat(each, np.stack([w.start - 1, w.end], 1).ravel(), axis=0)[::2]
        *affixes, h = self.word_features(w)
        for table, index in zip(self.affixes, affixes):
            out += table[index]
        return out + self.lexicon[h]


def posteriors(scores: np.ndarray, counts: np.ndarray, moves: np.ndarray, each: bool = False) -> np.ndarray:
    """Expected words of each label by text (texts, labels), or with `each` by word, by forward-backward.

    counts: words of each text, of which `scores` has the rows in order. Texts are cut into blocks;
    a block's steps multiply to one transfer matrix, so that messages pass from block to block and
    all blocks are then run at the same time.
    """
    n_labels = scores.shape[1]
    per = (counts + BLOCK_WORDS - 1) // BLOCK_WORDS
    n_blocks = int(per.sum())
    text_of = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(n_blocks) - np.repeat(np.cumsum(per) - per, per)
    begin = (np.cumsum(counts) - counts)[text_of] + nth * BLOCK_WORDS
    size = np.minimum(BLOCK_WORDS, counts[text_of] - nth * BLOCK_WORDS)
    order = np.argsort(-size, kind="stable")  # so that a step runs over the blocks before a limit
    rank = np.empty(n_blocks, np.int64)
    rank[order] = np.arange(n_blocks)
    begin, size, first = begin[order], size[order], nth[order] == 0
    step_blocks = np.searchsorted(-size, -np.arange(1, BLOCK_WORDS + 1), side="right")
    e = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float64) + 1e-30
    a = np.exp(moves - moves.max())

    matrix = np.broadcast_to(np.eye(n_labels), (n_blocks, n_labels, n_labels)).copy()
    for t, k in enumerate(step_blocks):
        if not k:
            break
        m = matrix[:k] @ a
        if t == 0:
            m[first[:k]] = matrix[:k][first[:k]]
        m *= e[begin[:k] + t][:, None, :]
        matrix[:k] = m / m.max((1, 2), keepdims=True)
    enter, leave = np.ones((n_blocks, n_labels)), np.ones((n_blocks, n_labels))
    for k in range(1, int(per.max(initial=0))):
        at = rank[nth == k]
        before = rank[np.flatnonzero(nth == k) - 1]
        x = np.einsum("ni,nij->nj", enter[before], matrix[before])
        enter[at] = x / x.max(1, keepdims=True)
    for k in range(int(per.max(initial=0)) - 1, 0, -1):
        at = rank[nth == k]
        before = rank[np.flatnonzero(nth == k) - 1]
        x = np.einsum("nij,nj->ni", matrix[at], leave[at])
        leave[before] = x / x.max(1, keepdims=True)

    alpha = np.empty_like(e)
    x = enter
    for t, k in enumerate(step_blocks):
        if not k:
            break
        y = x[:k] @ a
        if t == 0:
            y[first[:k]] = 1.0
        y *= e[begin[:k] + t]
        x = y / y.max(1, keepdims=True)
        alpha[begin[:k] + t] = x
    beta, sums = leave, np.zeros((n_blocks, n_labels))
    for t in range(BLOCK_WORDS - 1, -1, -1):
        k = step_blocks[t]
        if not k:
            continue
        at = begin[:k] + t
        p = alpha[at] * beta[:k]
        p /= p.sum(1, keepdims=True)
        if each:
            alpha[at] = p
        sums[:k] += p
        y = (e[at] * beta[:k]) @ a.T
        beta[:k] = y / y.max(1, keepdims=True)
    if each:
        return alpha
    out = np.zeros((len(counts), n_labels))
    np.add.at(out, text_of[order], sums)
    return out


def lane_gradients(e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e: (lanes, steps, labels) likelihoods. Word posteriors and expected moves summed over all lanes."""
    lanes, steps, _ = e.shape
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        x = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = x / x.sum(1, keepdims=True)
    pairs = np.zeros_like(a)
    for t in range(steps - 1, 0, -1):
        right = e[:, t] * beta[:, t]
        joint = alpha[:, t - 1, :, None] * a * right[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        x = right @ a.T
        beta[:, t - 1] = x / x.sum(1, keepdims=True)
    p = alpha * beta
    return p / p.sum(2, keepdims=True), pairs


def spliced(texts: list[str], langs: list[int], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Texts cut into spans of 3 to 60 words and dealt out in runs of few languages; the label of each span."""
    spans, label = [], []
    for text, lang in zip(texts, langs):
        parts, at = text.split(), 0
        while at < len(parts):
            n = int(rng.integers(3, 61))
            spans.append(" ".join(parts[at : at + n]))
            label.append(lang)
            at += n
    order = rng.permutation(len(spans))
    return [spans[i] for i in order], np.array(label, np.int64)[order]


def train(texts: list[str], langs: list[str], rounds: int = 30, lane: int = 64, rate: float = 0.35, decay: float = 1e-6, seen: int = 2) -> Model:
    """A model from whole labelled texts, by full-batch Adagrad on the conditional likelihood."""
    labels = sorted(set(langs), key=lambda x: x.encode("utf-8", "surrogatepass"))
    n = len(labels)
    model = Model(labels, np.zeros((2, GRAMS, n), np.float32), np.zeros((6, GRAMS, n), np.float32), np.zeros((LEXICON + 1, n), np.float32), np.zeros(LEXICON, bool), np.zeros((n, n)))
    spans, label = spliced(texts, [labels.index(x) for x in langs], np.random.default_rng(11))
    w = words_of(spans)
    steps = len(w.start) // lane * lane
    if not steps or n < 2:
        return model
    gold = np.repeat(label, w.counts)
    model.known = np.bincount((word_hashes(w) % np.uint64(LEXICON)).astype(np.int64), minlength=LEXICON) >= seen
    tables = [*model.grams, *model.affixes, model.lexicon]
    sums = [np.zeros_like(x) for x in tables]
    move_sum = np.zeros((n, n))
    pair_gold = np.zeros((n, n))
    lanes = gold[:steps].reshape(-1, lane)
    np.add.at(pair_gold, (lanes[:, :-1].ravel(), lanes[:, 1:].ravel()), 1)
    size = PART_LANES * lane
    for _ in range(rounds):
        grads, pairs = [np.zeros(x.shape[::-1]) for x in tables], np.zeros((n, n))
        for begin in range(0, steps, size):
            part = words_between(w, begin, min(begin + size, steps))
            s = model.scores(part).astype(np.float64)
            e = np.exp(s - s.max(1, keepdims=True)).reshape(-1, lane, n) + 1e-30
            p, moved = lane_gradients(e, np.exp(model.moves - model.moves.max()))
            pairs += moved
            g = -p.reshape(-1, n)
            g[np.arange(len(g)), gold[begin : begin + len(g)]] += 1
            g *= 1 / lane
            grow = part.end - part.start + 1
            owner = np.repeat(np.arange(len(grow)), grow)
            inner = np.arange(len(owner)) + np.repeat(part.start - 1 - (np.cumsum(grow) - grow), grow)
            features = [*((x[inner].astype(np.int64), owner) for x in model.gram_features(part)), *((x.astype(np.int64), None) for x in model.word_features(part))]
            for c in range(n):
                own = np.ascontiguousarray(g[:, c])
                for total, (index, of) in zip(grads, features):
                    total[c] += np.bincount(index, own if of is None else own[of], total.shape[1])
        for weights, total, d in zip(tables, sums, grads):
            for c in range(n):
                x = d[c] - decay * weights[:, c]
                total[:, c] += x * x
                weights[:, c] += rate * x / np.sqrt(total[:, c] + 1e-8)
        model.lexicon[LEXICON] = 0
        d = (pair_gold - pairs) / lane
        move_sum += d * d
        model.moves += rate * d / np.sqrt(move_sum + 1e-8)
    return model


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
    usable = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model.labels else []
    if usable:
        scores, counts, part, held = [], [], [], 0
        for k, i in enumerate(usable):
            part.append(texts[i])
            held += len(texts[i])
            if held >= PART_BYTES or k + 1 == len(usable):
                w = words_of(part)
                scores.append(model.scores(w))
                counts.append(w.counts)
                part, held = [], 0
        counts = np.concatenate(counts)
        expected = posteriors(np.concatenate(scores), counts, model.moves)
        for i, row, n in zip(usable, expected, counts):
            if n:
                best = int(row.argmax())
                langs[i], shares[i] = model.labels[best], float(min(max(row[best] / n, 0.0), 1.0))
    return langs, shares


def label_words(model: Model, text: str) -> list[tuple[str, str]]:
    """Each word of `text` (lower case) with its most probable language."""
    w = words_of([text])
    p = posteriors(model.scores(w), w.counts, model.moves, each=True) if len(w.start) else []
    return [(w.data[a:b].tobytes().decode("utf-8", "replace"), model.labels[int(x.argmax())]) for a, b, x in zip(w.start, w.end, p)]


def level(sizes: list[int], most: int) -> int:
    """The largest cap at which `sizes`, each cut to it, come to `most` at most."""
    left, cap = most, max(sizes, default=0)
    for n, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - n) > left:
            return left // (len(sizes) - n)
        left -= size
    return cap


def shared(found: list[tuple[int, str, str]], most_words: int) -> list[tuple[int, str, str]]:
    """(h, lang, text) with `most_words` words at most: what languages with few words leave goes to the others, and so among a language's texts."""
    words: dict[str, list[int]] = {}
    for _, lang, text in found:
        words.setdefault(lang, []).append(len(text.split()))
    share = level([sum(x) for x in words.values()], most_words)
    caps = {lang: level(x[:share], share) for lang, x in words.items()}
    out, taken = [], dict.fromkeys(words, 0)
    for h, lang, text in found:
        n = words[lang][taken[lang]]
        taken[lang] += 1
        if taken[lang] <= share:
            out.append((h, lang, text if n <= caps[lang] else " ".join(text.split()[: caps[lang]])))
    return out


def learned(docs: DataFrame, sample: int = 120, most_labels: int = 64, most_words: int = 300_000) -> Model:
    """A model from a bounded sample of `docs`' labelled rows that are not held out."""
    rows = docs.where(learnable()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)).alias("h"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_labels).collect()
    if not sizes:
        return train([], [])
    chosen = F.lit(False)
    for row in sizes:
        chosen = chosen | ((F.col("lang") == row["lang"]) & (F.col("h") < int(min(1.0, sample / row["count"]) * (1 << 30))))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted({(h, lang, text) for batch in batches for h, lang, text in zip(*(batch.column(c).to_pylist() for c in ("h", "lang", "text")))})
        found = shared(found, most_words)
        model = train([text for _, _, text in found], [lang for _, lang, _ in found])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # One task fits the bounded sample, and only that travels to it; the driver only passes the model on.
    return pickle.loads(rows.where(chosen).repartition(1).mapInArrow(lean(fit), "model binary").first()["model"])


def identified(docs: DataFrame, model: Model | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `docs`; with `columns` these in place of the first two."""
    small_batches(docs.sparkSession)
    model = model or learned(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out")
    own = docs.select(*columns) if columns else docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out)
    # A text that is passed through crosses to Python once.
    source = own if "text" in columns else own.withColumn("text", docs["text"].cast("string")) if columns else docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, F.col("text").cast("string").alias("text"))
    names = [*own.columns, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
            cut = np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_BYTES)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                if b > a:
                    langs, shares = predict(shipped.value, texts.slice(a, b - a).to_pylist())
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names[:-2]), pa.array(langs, pa.string()), pa.array(shares, pa.float64())], names=names)

    return source.mapInArrow(lean(run), T.StructType([*own.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))

"""Toxicity by compression distance (operator 4).

Method: two zstandard dictionaries, one trained on ordinary text, one on
toxic text behind the same ordinary content, so that the two differ in what
only toxic text has. A text is cut into windows of one word; the compressed
lengths of a window under the two dictionaries form a cell, and each cell has
a calibrated weight: the log of how much more often it comes in toxic than in
ordinary labelled texts. A logistic calibration turns the largest weight and
the sum over a threshold into a score; 0.5 is the threshold of rejection.

Windows are a few bytes, less than the fixed cost of a match, so each byte is
written as ``SPREAD`` bytes before compression: a word then costs far more as
literals than as one match, and lengths tell the two dictionaries apart.

The dictionaries come from one half of the labelled sample, weights and
calibration from the other. The toxic dictionary is trained on the words of
toxic texts that hold a byte run whose document frequency is significantly
higher there than in ordinary texts (z over ``MIN_Z``).

The sample is bounded (``TOXIC_DOCS``, ``ORDINARY_DOCS``, ``SAMPLE_BYTES``); all texts are scored
whole. The weights of words met before are kept in a bounded per-worker table.

Cases: null and empty texts have no window and get the score of no evidence;
without labelled rows of both kinds every score is 0; rows without a label do
not teach; output columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import hashed, sample_texts

TOXIC_DOCS, ORDINARY_DOCS = 2_000, 4_000  # labelled texts that are learnt, at most
SAMPLE_BYTES = 1 << 23                    # and bytes of each kind, at most
ORDINARY_BYTES, TOXIC_BYTES = 1 << 14, 1 << 14
LEVEL = 16          # compression level with an optimal parse
SPREAD = 3          # bytes written for each byte of a window
RUN = range(4, 9)   # lengths of the byte runs compared
MIN_Z = 6.0
WINDOW_BYTES = 64   # longer words are several windows
MARGIN = 1.5        # weight that a window must pass to count in the sum
CACHE_WORDS = 200_000

_letters = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_spread = [bytes((b * m + a) & 255 for b in range(256)) for m, a in ((1, 0), (37, 11), (101, 77), (59, 5))][:SPREAD]


def windows(text: str) -> list[bytes]:
    """The words of a text, lower case, long ones cut."""
    words = text.lower().encode().translate(_letters).split()
    if words and max(map(len, words)) > WINDOW_BYTES:
        return [w[i:i + WINDOW_BYTES] for w in words for i in range(0, len(w), WINDOW_BYTES)]
    return words


def spread(word: bytes) -> bytes:
    """A window as it is compressed: between spaces, bytes written wider."""
    word = b" " + word + b" "
    out = bytearray(len(word) * SPREAD)
    for k, t in enumerate(_spread):
        out[k::SPREAD] = word.translate(t)
    return bytes(out)


def _runs(word: bytes) -> set[bytes]:
    word = b" " + word + b" "
    return {word[i:i + n] for n in RUN for i in range(len(word) - n + 1)}


@dataclass
class Model:
    """What is learnt; plain data of bounded size, broadcast as it is."""
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    logistic: tuple[float, ...] = ()


class Scorer:
    """Compressors of a model and the weights of windows met before."""

    def __init__(self, model: Model):
        self.model = model
        self.ordinary, self.toxic = self._compressor(model.ordinary), self._compressor(model.toxic)
        self.known: dict[bytes, float] = {}

    @staticmethod
    def _compressor(content: bytes):
        import zstandard
        how = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    def cell(self, word: bytes) -> tuple[int, int]:
        """Compressed lengths of a window under the two dictionaries."""
        data = spread(word)
        return len(self.ordinary.compress(data)), len(self.toxic.compress(data))

    def weigh(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = {w for w in words if w not in known}
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(words)
        get = self.model.weights.get
        for w in new:
            known[w] = get(self.cell(w), 0.0)
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def evidence(self, text: str | None) -> tuple[float, float]:
        """(largest weight, log of 1 + the sum over the margin)."""
        w = self.weigh(windows(text or ""))
        return (max(0.0, float(w.max())), math.log1p(float(np.maximum(w - MARGIN, 0).sum()))) if len(w) else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        if not self.model.logistic:
            return 0.0
        bias, *slope = self.model.logistic
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, bias + sum(s * e for s, e in zip(slope, self.evidence(text)))))))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of samples; the samples themselves, the most
    frequent last, where they are too few to train on."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        count = Counter(samples)
        return b"".join(s for s, _ in reversed(count.most_common()))[-size:]


def train(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries, weights and calibration from labelled texts."""
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model()
    # ---- dictionaries, from the first half
    bad, good = Counter(), Counter()
    for count, texts in ((bad, toxic[::2]), (good, ordinary[::2])):
        for t in texts:
            count.update(set(windows(t)))
    runs, plain = Counter(), Counter()
    for w, n in bad.items():
        if w not in good:
            runs.update(dict.fromkeys(_runs(w), n))
    runs = Counter({r: n for r, n in runs.items() if n >= 4})
    for w, n in good.items():
        plain.update(dict.fromkeys(_runs(w) & runs.keys(), n))
    share = len(toxic[::2]) / (len(toxic[::2]) + len(ordinary[::2]))

    def z(run: bytes) -> float:
        n = runs[run] + plain[run]
        return (runs[run] - n * share) / math.sqrt(n * share * (1 - share))

    telling = {r for r in runs if runs[r] > 4 * plain[r] and z(r) > MIN_Z}
    told = {w: n for w, n in bad.items() if not telling.isdisjoint(_runs(w))}
    usual = [spread(w) for w, n in sorted(good.items()) for _ in range(min(n, 20))]
    usual = [usual[i] for i in np.random.default_rng(7).permutation(len(usual))[:400_000]]
    content = _dictionary([b"".join(usual[i:i + 8]) for i in range(0, len(usual), 8)], ORDINARY_BYTES)
    words = sorted(told, key=lambda w: (told[w], w))
    own = b"".join(spread(w) for w in words)
    if len(own) > TOXIC_BYTES:
        own = _dictionary([spread(w) for w in words for _ in range(told[w])], TOXIC_BYTES)
    model = Model(content, content + own)
    # ---- weights of cells, from the second half
    scorer = Scorer(model)
    cells: dict[bytes, tuple[int, int]] = {}
    counts = []
    for texts in (toxic[1::2], ordinary[1::2]):
        words_of = Counter(w for t in texts for w in windows(t))
        for w in words_of:
            if w not in cells:
                cells[w] = scorer.cell(w)
        count = Counter()
        for w, n in words_of.items():
            count[cells[w]] += n
        counts.append(count)
    total = [max(1, sum(c.values())) for c in counts]
    model.weights = {c: math.log((counts[0][c] + .5) / total[0]) - math.log((counts[1][c] + .5) / total[1]) for c in counts[0] | counts[1]}
    # ---- calibration: logistic regression by Newton steps, lightly held back
    scorer = Scorer(model)
    x = np.array([(1.0, *scorer.evidence(t)) for t in [*toxic[1::2], *ordinary[1::2]]])
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(ordinary[1::2]))
    beta, hold = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + hold, x.T @ (y - p) - hold @ beta)
        beta += np.clip(step, -4, 4)
    model.logistic = tuple(beta.tolist())
    return model


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS, size: int = SAMPLE_BYTES) -> Model:
    """A model from the rows of ``df`` that ``labels`` (``id_col``,
    ``label_col``: 1 toxic, 0 ordinary) marks: of each kind up to the given
    number of different whole texts of up to ``size`` bytes together."""
    texts = hashed(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    kind = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    found = sample_texts(texts.drop("text").join(kind, "id"), texts, {1: toxic_docs, 0: ordinary_docs}, size)
    return train(found.get(1, []), found.get(0, []))


_ready: dict[bytes, Scorer] = {}


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add ``score_col`` (0 to 1) of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = shared.value.toxic + repr(shared.value.logistic).encode()
        if key not in _ready:
            _ready.clear()
            _ready[key] = Scorer(shared.value)
        scorer = _ready[key]
        for texts in batches:
            yield pa.array([scorer.score(t.as_py()) for t in texts], pa.float64())
        scorer.known.clear()   # the worker goes on with other operators

    return df.withColumn(score_col, scored(F.col(text_col)))

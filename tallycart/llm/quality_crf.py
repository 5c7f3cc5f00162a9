"""Quality rules by line labelling: a linear-chain conditional random field.

Every line with a word gets a label, content or boilerplate, by Viterbi decoding over
the document's lines. The share of words in content lines decides retention, after
plain base rules (too few words, too much repetition).

The field has one weight per line feature and one per change of label. It is fitted on
at most ``SAMPLE`` labelled documents of at most ``SAMPLE_LINES`` lines (those with the
least hash of their id): each line takes its document's quality label, a weak one, and
the penalised conditional likelihood is climbed by gradient steps from fixed start
weights, which also serve where there are no labels of both kinds. Everything else
looks at every document and its whole text.

Defined results. Null or empty text has no words and fails the base rules. Rows with a
null or repeated ``doc_id`` are judged like any other. Labels that are null are not used;
a document labelled more than once counts with its least label. Other columns pass
through ``keep_content`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm import words as W

SAMPLE = 1_000
SAMPLE_LINES = 100
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words
MIN_CONTENT = 0.5  # share of words in content lines

FEATURES = [
    "bias",
    "upper",
    "symbols",
    "exclaim",
    "digits",
    "repeats",
    "stop_end",
    "length",
    "short",
    "edge",
]
# Fixed start weights: towards content, in the order of FEATURES.
START = [1.5, -4.0, -12.0, -12.0, -4.0, -6.0, 0.5, 0.5, -0.5, 0.0]
CHANGE = -1.0


@dataclass(frozen=True)
class LineField:
    """Weights of the features (score of content over boilerplate) and of a change of label."""

    weights: tuple[float, ...] = tuple(START)
    change: float = CHANGE

    def decode(self, lines: np.ndarray) -> np.ndarray:
        """The best label of each line: True for content. Ties go to content."""
        n = len(lines)
        content = (lines @ np.asarray(self.weights)).tolist()
        back = np.zeros((n, 2), bool)
        bad = good = 0.0
        for i, score in enumerate(content):
            if i:
                from_bad, from_good = bad, good
                stay_good = from_good >= from_bad + self.change
                leave_bad = from_good + self.change >= from_bad
                back[i] = leave_bad, stay_good
                good = from_good if stay_good else from_bad + self.change
                bad = from_good + self.change if leave_bad else from_bad
            good += score
        labels = np.zeros(n, bool)
        state = good >= bad
        for i in range(n - 1, -1, -1):
            labels[i] = state
            state = back[i, int(state)]
        return labels


# The byte classes of a line.
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
UPPER = np.isin(np.arange(256), np.arange(65, 91))
LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(192, 256)])
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
EXCLAIM = np.isin(np.arange(256), list(b"!"))
STOP = np.isin(np.arange(256), list(b".!?:;"))
HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


@dataclass
class Page:
    """What the rules and the field read off one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: np.ndarray  # words of each line that has one
    lines: np.ndarray  # features of those lines


def read_page(text: bytes | None) -> Page:
    text = text or b""
    data = np.frombuffer(text, np.uint8)
    hashes = W.HASHES.of(text.split())
    if not len(hashes):
        symbols = int(SYMBOL[data].sum())
        return Page(0, 0, symbols, 0, 0, np.empty(0, np.int64), np.empty((0, len(FEATURES))))
    space = SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    at = np.flatnonzero(begins)
    newline = np.flatnonzero(data == 10)
    lo, hi = np.append(0, newline + 1), np.append(newline, len(data))
    line_of = np.searchsorted(newline, at)
    line_words = np.bincount(line_of, minlength=len(lo))

    def per_line(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[hi] - sums[lo]

    heads = HEAD[data] & ~space
    symbol = SYMBOL[data]
    chars = np.maximum(per_line(heads), 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of[same], minlength=len(lo))
    size = np.maximum(line_words, 1)
    shorts = np.diff(np.append(at, len(data))) <= 4
    # The last byte of a line's last word: the last one that is no space.
    solid = np.flatnonzero(~space)
    last = solid[np.maximum(np.searchsorted(solid, hi) - 1, 0)]
    used = line_words > 0
    edge = np.zeros(len(lo))
    edge[np.flatnonzero(used)[[0, -1]]] = 1.0
    lines = np.stack(
        [
            np.ones(len(lo)),
            per_line(UPPER[data]) / np.maximum(per_line(LETTER[data]), 1),
            per_line(symbol) / chars,
            per_line(EXCLAIM[data]) / chars,
            per_line(DIGIT[data]) / chars,
            repeats / size,
            STOP[data[last]].astype(float),
            np.log1p(size) / 5,
            np.bincount(line_of[shorts], minlength=len(lo)) / size,
            edge,
        ],
        axis=1,
    )[used]

    windows = W.rolling(hashes, 3)
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.zeros(len(hashes) + 3, bool)
    hit = np.flatnonzero(count[which] > 1) if len(windows) else np.empty(0, np.int64)
    for step in range(3):
        twice[hit + step] = True

    seen: set[bytes] = set()
    dup = 0
    if len(lo) > 1:
        for line, n in zip(text.split(b"\n"), line_words.tolist()):
            if n:
                dup += line in seen
                seen.add(line)
    return Page(
        len(hashes), int(heads.sum()), int(symbol.sum()), dup, int(twice.sum()), line_words[used], lines
    )


def verdict(page: Page, field: LineField) -> tuple[bool, int, float, bool]:
    """base_failed, content lines, share of words in them, kept."""
    failed = page.n_words < MIN_WORDS or 100 * page.n_repeat_words > MAX_REPEATED * page.n_words
    labels = field.decode(page.lines)
    share = float(page.line_words[labels].sum()) / page.n_words if page.n_words else 0.0
    return failed, int(labels.sum()), share, not failed and share >= MIN_CONTENT


_ASSESSED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long, n_content_lines long, content_share double, "
    "base_failed boolean, kept boolean"
)


def assess(docs: DataFrame, field: LineField) -> DataFrame:
    """One row per document: what the rules counted, what the field marked, the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _ASSESSED.split(", ")]
        for batch in W.pieces(batches):
            rows = []
            for text in W.utf8(batch.column(1)):
                page = read_page(text)
                failed, content, share, kept = verdict(page, field)
                counts = (page.n_words, page.word_chars, page.n_symbols, page.n_dup_lines)
                rows.append(
                    (*counts, page.n_repeat_words, len(page.lines), content, share, failed, kept)
                )
            columns = zip(*rows) if rows else [[]] * 10
            kinds = [pa.int64()] * 7 + [pa.float64(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    return docs.select(F.col("doc_id").cast("long"), "text").transform(map_batches, run, _ASSESSED)


def keep_content(docs: DataFrame, field: LineField) -> DataFrame:
    """The documents that are kept, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            texts = W.utf8(batch.column(at))
            yield batch.filter(pa.array([verdict(read_page(t), field)[3] for t in texts], pa.bool_()))

    return docs.transform(map_batches, run, docs.schema)


def sample_lines(
    docs: DataFrame, labels: DataFrame, documents: int = SAMPLE, lines: int = SAMPLE_LINES
) -> list[tuple[np.ndarray, bool]]:
    """Line features and quality label of a bounded sample of labelled documents."""
    known = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    # At most ``documents`` short rows: a fixed bound, whatever the size of the input.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            pages = [read_page(t).lines for t in W.utf8(batch.column(1))]
            fits = [0 < len(p) <= lines for p in pages]
            columns = [
                batch.column(0).filter(pa.array(fits, pa.bool_())),
                batch.column(2).filter(pa.array(fits, pa.bool_())),
                W.lists_of([p.ravel() for p, ok in zip(pages, fits) if ok], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "lines"])

    rows = texts.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).transform(
        map_batches, run, "doc_id long, quality int, lines array<double>"
    )
    found = sorted((r.doc_id, r.lines, r.quality) for r in rows.collect())
    return [(np.asarray(x).reshape(-1, len(FEATURES)), q == 1) for _, x, q in found]


def fit(sample: list[tuple[np.ndarray, bool]], steps: int = 100, rate: float = 0.5, penalty: float = 1e-3) -> LineField:
    """Climb the mean conditional log-likelihood of the labels from the start weights."""
    if len({label for _, label in sample}) < 2:
        return LineField()
    longest = max(len(x) for x, _ in sample)
    x = np.zeros((len(sample), longest, len(FEATURES)))
    live = np.zeros((len(sample), longest), bool)
    for i, (lines, _) in enumerate(sample):
        x[i, : len(lines)], live[i, : len(lines)] = lines, True
    y = np.array([label for _, label in sample])
    # Documents weigh the same, whatever their length.
    weight = 1.0 / live.sum(1) / len(sample)
    start = np.array([*START, CHANGE])
    theta, momentum, scale = start.copy(), np.zeros_like(start), np.zeros_like(start)
    truth = np.where(live, y[:, None], False)
    for step in range(1, steps + 1):
        share, changes = _expected(x @ theta[:-1], theta[-1], live)
        rest = (truth - share) * live * weight[:, None]
        slope = np.append(np.einsum("ij,ijk->k", rest, x), -(changes * weight).sum())
        slope -= penalty * (theta - start)
        momentum = 0.9 * momentum + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        theta += rate * (momentum / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8) / np.sqrt(step)
    return LineField(tuple(float(v) for v in theta[:-1]), float(min(theta[-1], 0.0)))


def _expected(score: np.ndarray, change: float, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: chance of content per line, expected changes of label per document."""
    n, longest = score.shape
    emit = np.stack([np.zeros_like(score), score], axis=2)
    move = np.array([[0.0, change], [change, 0.0]])
    ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = emit[:, 0]
    for i in range(1, longest):
        step = np.logaddexp.reduce(ahead[:, i - 1, :, None] + move, axis=1) + emit[:, i]
        ahead[:, i] = np.where(live[:, i, None], step, ahead[:, i - 1])
    for i in range(longest - 2, -1, -1):
        step = np.logaddexp.reduce(move + (emit[:, i + 1] + behind[:, i + 1])[:, None, :], axis=2)
        behind[:, i] = np.where(live[:, i + 1, None], step, 0.0)
    total = np.logaddexp.reduce(ahead[:, -1], axis=1)
    share = np.where(live, np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]), 0.0)
    pair = ahead[:, :-1, :, None] + move + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
    chance = np.exp(pair - total[:, None, None, None]) * live[:, 1:, None, None]
    return share, (chance[..., 0, 1] + chance[..., 1, 0]).sum(axis=1)

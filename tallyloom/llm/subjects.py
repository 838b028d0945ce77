"""Subject areas of texts by interpolated n-gram language models.

A text is split into sentences and lines. For each subject a language model (bigrams over unigrams
over the corpus) is trained on labelled texts: labels name the subjects of a text, not of its
sentences, so the models are found by expectation maximisation, each sentence belonging to a labelled
subject or to office routine. There are two background models, one of that routine and one of the
corpus, all sentences together. A sentence is about the subject under which its cross-entropy per
token is lowest, if that is below routine and the runner-up by a margin, which is wider for short
sentences, whose cross-entropy is less certain, and not above that of the corpus by more than a
tolerance; a subject is accepted for a text by its share of the sentences. Margin, tolerance and
shares are calibrated on labelled texts that the models have not seen.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled texts that the models are fitted on at most, and the words of each, in sentences drawn evenly over the whole text. Classification has no bound.
SAMPLE_TEXTS, SAMPLE_WORDS = 6000, 6000
ROUNDS = 6
#: Share of the sentences that may come from subjects without a label, as annotators err.
MISLABELLED = 0.02
#: Counts that the corpus adds to a subject's unigrams, and unigrams to the bigrams after a word.
UNIGRAM_PRIOR, BIGRAM_PRIOR = 200.0, 20.0
#: How much of what a subject's bigrams are interpolated with is the corpus's bigrams; the rest is the subject's unigrams.
CORPUS_SHARE = 0.5
#: Sentences that a worker remembers.
REMEMBERED = 200_000
#: Margins (nats per token, nats to be divided by the number of tokens, tolerance towards the corpus), shares of a text's sentences, and lengths of short texts among which calibration chooses.
Margin = tuple[float, float, float]
MARGINS: tuple[Margin, ...] = tuple(product((0.0, 0.05, 0.1), (0.5, 1.0, 2.0), (0.0, 2.0)))
SHARES, SHORT = (0.14, 0.15, 0.16, 0.17, 0.18, 0.2), (2, 3, 5)

_TAGS = re.compile(r"</?(?:p|br|li|ul|ol|div|tr|td|th|table|h\d)\b[^>\n]{0,200}>", re.I)
_INLINE = re.compile(r"</?[A-Za-z][^>\n]{0,200}>")
_UNSEEN = re.compile("[\u200b-\u200d\u2060\ufeff\u00ad]")
_BREAK = re.compile(r"[\r\n\x0b\x0c\x85\u2028\u2029]+|(?<!^\d\.)(?<!^\d\d\.)(?<=[.!?…])\s+", re.M)
_BULLET = re.compile(r"^\s*(?:\d{1,3}[.)]|[-*•※#>]+)\s*")
_WORD = re.compile(r"[^\W\d_]+(?:'[a-z]+)?|\d+")
_NAME = re.compile(r"[/_=]|[a-z][A-Z]|[0-9a-f]{12}")


@lru_cache(100_000)
def _words(chunk: str) -> tuple[str, ...]:
    """The words between two blanks: ``@`` for the name of an operation, field or path, ``#`` for a number."""
    if _NAME.search(chunk):
        return ("@",)
    return tuple("#" if w[0].isdigit() else w.lower() for w in _WORD.findall(chunk))


def sentences(text: str | None) -> list[tuple[str, ...]]:
    """The sentences and lines of a text as tuples of words; numbers and names of operations, fields and paths are one word each.

    Markup, numbering and invisible characters are left out, decomposed letters composed. Null, empty
    and blank texts have no sentences.
    """
    plain = unicodedata.normalize("NFC", _UNSEEN.sub("", text or ""))
    if "<" in plain or "&" in plain:
        plain = html.unescape(_INLINE.sub(" ", _TAGS.sub("\n", plain)))
    found = []
    for line in _BREAK.split(plain):
        words = tuple(w for chunk in _BULLET.sub("", line).split() for w in _words(chunk))
        if words:
            found.append(words)
    return found


@dataclass
class Models:
    """Bigrams and unigrams as log probabilities by subject; the last two columns are the backgrounds. ``met`` has the sentences judged so far, by margin."""

    subjects: list[str]
    words: dict[str, int]
    pairs: dict[str, int]
    pair_logs: np.ndarray
    word_logs: np.ndarray
    start_logs: np.ndarray
    margin: Margin = (0.05, 1.0, 0.0)
    share: float = 0.16
    short: int = 3
    met: dict = field(default_factory=dict)

    def scores(self, asked: list[tuple[str, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """The cross-entropy per token of each sentence under each model, 0 without any known token, and the number of known tokens, at least 1. Words that were never seen tell nothing and are left out."""
        seen, seen_of, rows, after, of = [], [], [], [], []
        for n, sentence in enumerate(asked):
            last = "\x02"
            for word in sentence:
                pair = self.pairs.get(f"{last} {word}")
                if pair is not None:
                    seen.append(pair)
                    seen_of.append(n)
                elif (known := self.words.get(word)) is not None:
                    rows.append(known)
                    after.append(self.words.get(last, len(self.words)))
                    of.append(n)
                last = word
        seen, seen_of, rows, after, of = (np.array(x, np.int64) for x in (seen, seen_of, rows, after, of))
        total = np.zeros((len(asked), self.pair_logs.shape[1]))
        for k in range(total.shape[1]):
            total[:, k] = np.bincount(seen_of, self.pair_logs[seen, k], len(asked)) + np.bincount(of, self.word_logs[rows, k] + self.start_logs[after, k], len(asked))
        tokens = np.maximum(np.bincount(seen_of, minlength=len(asked)) + np.bincount(of, minlength=len(asked)), 1)
        return -total / tokens[:, None], tokens

    def about(self, scores: np.ndarray, tokens: np.ndarray, margin: Margin) -> list[int]:
        """The number of the subject that each sentence of these ``scores`` is about, -1 for none."""
        k = len(self.subjects)
        if not k:
            return [-1] * len(scores)
        ordered = np.sort(scores[:, :k], axis=1)
        routine, corpus = scores[:, k], scores[:, k + 1]
        other = np.minimum(routine, ordered[:, 1]) if k > 1 else routine
        clear = (other - ordered[:, 0] > margin[0] + margin[1] / tokens) & (corpus + margin[2] > ordered[:, 0])
        return np.where(clear, scores[:, :k].argmin(axis=1), -1).tolist()

    def votes(self, texts: list[list[tuple[str, ...]]], margin: Margin) -> np.ndarray:
        """By text and subject: the sentences about it. Sentences that were met before are looked up."""
        known = self.met.setdefault(margin, {})
        if len(known) > REMEMBERED:
            known.clear()
        new = list({s for t in texts for s in t if s not in known})
        known.update(zip(new, self.about(*self.scores(new), margin), strict=True))
        votes = np.zeros((len(texts), len(self.subjects)), np.int64)
        for row, text in enumerate(texts):
            for sentence in text:
                if (k := known[sentence]) >= 0:
                    votes[row, k] += 1
        return votes

    def accept(self, texts: list[list[tuple[str, ...]]], votes: np.ndarray, share: float, short: int) -> np.ndarray:
        """Which subjects count: by share, and more than a single mention in all but short texts."""
        n = np.array([len(t) for t in texts])[:, None]
        return (votes > 0) & (votes >= share * n) & ((votes > 1) | (n < short))

    def classify(self, texts: list[str | None]) -> list[list[str]]:
        split = [sentences(t) for t in texts]
        accepted = self.accept(split, self.votes(split, self.margin), self.share, self.short)
        return [[self.subjects[k] for k in np.flatnonzero(row)] for row in accepted]


def fit(texts: list[list[tuple[str, ...]]], shares: np.ndarray, subjects: list[str], rounds: int = ROUNDS) -> Models:
    """The models of labelled texts. ``shares`` has the votes of the annotators by text and subject."""
    k = len(subjects)
    prior = np.concatenate([shares, np.ones((len(texts), 1))], axis=1)
    prior = (1 - MISLABELLED) * prior / prior.sum(axis=1, keepdims=True) + MISLABELLED / (k + 1)
    words: dict[str, int] = {}
    pairs: dict[str, int] = {}
    word_at, pair_at, sizes, owner = [], [], [], []
    for number, text in enumerate(texts):
        for sentence in text:
            word_at += [words.setdefault(w, len(words)) for w in sentence]
            pair_at += [pairs.setdefault(f"{a} {b}", len(pairs)) for a, b in zip(["\x02", *sentence], sentence, strict=False)]
            sizes.append(len(sentence))
            owner.append(number)
    v, p = len(words), len(pairs)
    w, g, sid = np.array(word_at, np.int64), np.array(pair_at, np.int64), np.repeat(np.arange(len(sizes)), np.array(sizes, np.int64))
    before = np.array([words.get(x.partition(" ")[0], v) for x in pairs], np.int64)
    second = np.array([words[x.partition(" ")[2]] for x in pairs], np.int64)
    corpus = np.bincount(w, minlength=v) + 0.5
    corpus /= corpus.sum()
    log_prior = np.log(prior)[np.array(owner, np.int64)]
    posterior = np.exp(log_prior)
    pair_logs, word_logs, start_logs = np.zeros((p, k + 2)), np.zeros((v, k + 2)), np.zeros((v + 1, k + 2))

    def model(c: int, weight: np.ndarray | None) -> None:
        ones = np.bincount(w, weight, v)
        twos = np.bincount(g, weight, p)
        base = (ones + UNIGRAM_PRIOR * corpus) / (ones.sum() + UNIGRAM_PRIOR)
        context = np.bincount(before, twos, v + 1)
        word_logs[:, c] = np.log(base)
        start_logs[:, c] = np.log(BIGRAM_PRIOR / (context + BIGRAM_PRIOR))
        expected = base[second] if weight is None else CORPUS_SHARE * whole + (1 - CORPUS_SHARE) * base[second]
        pair_logs[:, c] = np.log((twos + BIGRAM_PRIOR * expected) / (context[before] + BIGRAM_PRIOR))

    model(k + 1, None)  # the corpus, all sentences together
    whole = np.exp(pair_logs[:, k + 1])
    for _ in range(rounds):
        likely = np.zeros_like(log_prior)
        for c in range(k + 1):
            model(c, posterior[sid, c])
            likely[:, c] = log_prior[:, c] + np.bincount(sid, pair_logs[g, c], len(sizes))
        posterior = np.exp(likely - likely.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
    return Models(subjects, words, pairs, pair_logs.astype(np.float32), word_logs.astype(np.float32), start_logs.astype(np.float32))


def calibrate(texts: list[list[tuple[str, ...]]], shares: np.ndarray, subjects: list[str]) -> Models:
    """Models fitted on all texts, with margin, share and short length chosen on every fifth text, left out of a first fit."""
    held = np.arange(len(texts)) % 5 == 0
    if held.sum() < 10:
        return fit(texts, shares, subjects)
    first = fit([t for t, h in zip(texts, held, strict=True) if not h], shares[~held], subjects)
    asked = [t for t, h in zip(texts, held, strict=True) if h]
    truth = shares[held] > 0.5
    known = truth | (shares[held] == 0)
    best: tuple = (-1.0, 0, MARGINS[0], SHARES[0], SHORT[0])
    once = list({s for t in asked for s in t})
    scores = first.scores(once)
    for margin in MARGINS:
        first.met[margin] = dict(zip(once, first.about(*scores, margin), strict=True))
        votes = first.votes(asked, margin)
        for n, (share, short) in enumerate(product(SHARES, SHORT)):
            got = first.accept(asked, votes, share, short)
            right, wrong, missed = (got & truth).sum(), (got & ~truth & known).sum(), (~got & truth).sum()
            best = max(best, (2 * right / max(1, 2 * right + wrong + missed), -n, margin, share, short))
    models = fit(texts, shares, subjects)
    models.margin, models.share, models.short = best[2:]
    return models


def drawn_sentences(text: str | None, words: int = SAMPLE_WORDS) -> list[tuple[str, ...]]:
    """Sentences of a text, evenly over the whole of it, of at most about ``words`` words; all if it has no more. A single longer sentence is left out."""
    found = [s for s in sentences(text) if len(s) <= words]
    step = max(1, -(-sum(map(len, found)) // words))
    return found[::step]


_FITTED: dict[str, Models] = {}


def train(documents: DataFrame, labels: DataFrame, row_id: str, text: str, subjects: list[str], sample: int = SAMPLE_TEXTS) -> Models:
    """Models from a sample of at most ``sample`` labelled texts, drawn by a hash of their id.

    ``labels`` has ``row_id``, ``subject`` and ``annotator``; a null subject means none, unknown
    subjects are passed over. Of a long text, sentences of about ``SAMPLE_WORDS`` words are drawn, on the
    executors; null texts have none. Without labelled texts the models accept nothing. The same
    sample is fitted once in a process.
    """
    chosen = F.broadcast(labels.select(row_id).filter(F.col(row_id).isNotNull()).distinct().orderBy(F.xxhash64(row_id), row_id).limit(sample))
    votes = labels.join(chosen, row_id, "left_semi").select(row_id, "subject", F.coalesce(F.col("annotator").cast("string"), F.lit("")).alias("annotator"))
    annotators = dict(votes.groupBy(row_id).agg(F.countDistinct("annotator")).collect())
    counts = votes.filter(F.col("subject").isin(subjects)).groupBy(row_id, "subject").agg(F.countDistinct("annotator").alias("n")).collect()
    kind = dict(documents.dtypes)[row_id]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [[" ".join(s) for s in drawn_sentences(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(drawn, pa.list_(pa.string()))], [row_id, "sentences"])

    known = documents.select(row_id, text).filter(F.col(text).isNotNull()).join(chosen, row_id, "left_semi")
    texts = known.mapInArrow(draw, f"`{row_id}` {kind}, sentences array<string>").groupBy(row_id).agg(F.min("sentences").alias("sentences")).collect()
    rows = sorted(texts, key=lambda r: r[row_id])
    at = {r[row_id]: n for n, r in enumerate(rows)}
    column = {s: n for n, s in enumerate(subjects)}
    shares = np.zeros((len(rows), len(subjects)))
    for r in counts:
        if r[row_id] in at:
            shares[at[r[row_id]], column[r.subject]] = r.n / annotators[r[row_id]]
    key = hashlib.sha256(repr((subjects, [r.sentences for r in rows])).encode("utf-8", "surrogatepass") + shares.tobytes()).hexdigest()
    if key not in _FITTED:
        _FITTED.clear()
        _FITTED[key] = calibrate([[tuple(s.split(" ")) for s in r.sentences] for r in rows], shares, subjects)
    return replace(_FITTED[key], met={})


def assign(documents: DataFrame, row_id: str, text: str, models: Models, batch: int = 500) -> DataFrame:
    """``row_id`` and ``subject``: a row for each subject that a text deals with; none for texts without one.

    Repeated rows come out again; other columns are dropped.
    """
    kind = dict(documents.dtypes)[row_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), batch):
                part = whole.slice(start, batch)
                found = models.classify(part.column(1).to_pylist())
                at = np.repeat(np.arange(len(part)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array([s for f in found for s in f], pa.string())], [row_id, "subject"])

    return documents.select(row_id, text).mapInArrow(run, f"`{row_id}` {kind}, subject string")


def composition(found: DataFrame, documents: DataFrame, row_id: str, by: str) -> DataFrame:
    """Texts by subject and by the column ``by`` of the documents, with their share of that column's assignments."""
    if by == "subject":
        raise ValueError("the column must not be called subject")
    counts = found.join(documents.select(row_id, by), row_id).groupBy(by, "subject").agg(F.count("*").alias("documents"))
    share = F.col("documents") / F.sum("documents").over(Window.partitionBy(by))
    return counts.select(by, "subject", "documents", share.alias("share"))

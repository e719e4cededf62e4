"""Language identification by a linear-chain conditional random field over words.

Features of a word are its affixes, its character trigrams and, for words met often enough
in the sample, the word itself.  Transitions are learned from sequences of short
stretches of different documents, as in code-switched text.  Forward-backward gives each
word the probability of each language; a document's language is the one with the largest
share of its words.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.common import held, map_batches, text_or_empty
from twinfold.llm.crf import CELLS, Chain, Features, KindScores, forward_backward, hashed, padded

# Longer runs of letters, as in scripts without spaces, are cut into several words.
WORD = re.compile(r"[^\W\d_]{1,40}")
SIZE = 1 << 16
STRETCH, STRETCHES = 16, 4  # words of one document, and such stretches in a training sequence
LEXICON_MIN = 3
UNDETERMINED = "und"
PORTION_CHARS = 2_000_000

# Bounds of the sample that the model is fitted on.  Every language is learned; with more than
# SAMPLE_ROWS / SAMPLE_PER_LANGUAGE of them each has fewer rows, down to SAMPLE_LEAST.
SAMPLE_PER_LANGUAGE = 150
SAMPLE_ROWS = 15_000
SAMPLE_LEAST = 10


def words_of(text: str) -> list[str]:
    words = WORD.findall(text.lower())
    # \w also has numbers that are not digits; a word needs a letter.
    return words if all(map(str.isalpha, words)) else [w for w in words if any(map(str.isalpha, w))]


def word_features(word: str, lexicon: frozenset[str]) -> list[int]:
    marked = f"<{word}>"
    names = ["bias"]
    names += [f"p{word[:n]}" for n in (1, 2, 3, 4)] + [f"s{word[-n:]}" for n in (1, 2, 3, 4)]
    names += [f"g{marked[i : i + 3]}" for i in range(len(marked) - 2)]
    if word in lexicon:
        names.append(f"w{word}")
    return hashed(names, SIZE)


def _portions(texts: list[str], chars: int = PORTION_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose words are held at a time: about ``chars``, or a single text."""
    a, size = 0, 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > chars:
            yield a, b
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in stretches of rows whose texts are judged at a time, so that only theirs become Python's."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    a, size = 0, 0
    for b, n in enumerate(sizes):
        if b > a and size + n > PORTION_CHARS:
            yield batch.slice(a, b - a)
            a, size = b, 0
        size += n
    if a < len(sizes):
        yield batch.slice(a)


def cells_of(languages: int) -> int:
    """Padded tokens that are labelled together: fewer with many languages, as each has a number a token."""
    return max(1, CELLS * 8 // max(8, languages))


class LanguageModel:
    def __init__(self, languages: list[str], lexicon: frozenset[str], chain: Chain):
        self.languages, self.lexicon, self.chain = languages, lexicon, chain
        self.number = uuid.uuid4().hex  # workers tell models apart by it

    def labeller(self) -> Labeller:
        """One for all tasks of a worker, which keeps the words it has met."""
        return held("language", self.number, lambda: Labeller(self))


class Labeller:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.kinds = KindScores(
            model.chain,
            lambda w: [word_features(w, model.lexicon)],
            lambda scores: np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12,
            most=max(1, 500_000 * 8 // max(8, len(model.languages))),
        )
        self.transitions = np.exp(model.chain.transitions)

    def word_probabilities(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the probability of each language for each word."""
        words = [words_of(t) for t in texts]
        out = [np.zeros((len(w), len(self.model.languages))) for w in words]
        for rows, marginals in self._marginals(words):
            for j, r in enumerate(rows):
                out[r] = marginals[: len(words[r]), j]
        return out

    def shares(self, texts: list[str]) -> np.ndarray:
        """For each text the share of each language in its words; zeros without words."""
        out = np.zeros((len(texts), len(self.model.languages)))
        for a, b in _portions(texts):
            for rows, marginals in self._marginals([words_of(t) for t in texts[a:b]]):
                out[a + rows] = marginals.sum(axis=0)
        return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)

    def _marginals(self, words: list[list[str]]):
        lengths = np.array([len(w) for w in words], np.int64)
        for rows in padded(lengths, cells_of(len(self.model.languages))):
            self.kinds.add({w for r in rows for w in words[r]})
            number = self.kinds.numbers.__getitem__
            steps = int(lengths[rows[0]])
            kinds = np.zeros((steps, len(rows)), np.int64)
            for j, r in enumerate(rows):
                kinds[: lengths[r], j] = np.fromiter(map(number, words[r]), np.int64, lengths[r])
            active = (lengths[rows][None, :] > np.arange(steps)[:, None]).sum(axis=1)
            yield rows, forward_backward(self.kinds.tables[0][kinds], self.transitions, active)[0]


def fit(rows: list[tuple[str, str]], seed: int = 0) -> LanguageModel:
    """The model of (text, language) rows."""
    languages = sorted({lang for _, lang in rows})
    label = {lang: i for i, lang in enumerate(languages)}
    stretches = []
    counts: Counter[str] = Counter()
    for text, lang in sorted(rows):
        words = words_of(text)
        counts.update(words)
        stretches += [(words[i : i + STRETCH], label[lang]) for i in range(0, len(words), STRETCH)]
    lexicon = frozenset(w for w, n in counts.items() if n >= LEXICON_MIN)
    kinds = {w: i for i, w in enumerate(sorted(counts))}
    order = np.random.default_rng(seed).permutation(len(stretches))
    tokens, labels = [], []
    for at in range(0, len(order), STRETCHES):
        chosen = [stretches[i] for i in order[at : at + STRETCHES]]
        tokens.append(np.array([kinds[w] for words, _ in chosen for w in words], np.int64))
        labels.append(np.array([y for words, y in chosen for _ in words], np.int64))
    chain = Chain(len(languages), SIZE)
    features = Features([word_features(w, lexicon) for w in kinds])
    chain.fit([features], tokens, labels, rounds=25)
    for weights in chain.weights:
        weights[:] = weights.astype(np.float32)
    return LanguageModel(languages, lexicon, chain)


def sample(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` (text, lang) rows of every language, and fewer of each if there are
    very many languages, chosen by a hash of id and text; at least one row of each."""
    rows = documents.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text", F.lit("sample")).alias("draw"),
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).collect()
    if not counts:
        return []
    wanted = min(per_language, max(SAMPLE_LEAST, SAMPLE_ROWS // len(counts)))
    shares = documents.sparkSession.createDataFrame(
        [(r["lang"], r["least"], min(1.0, wanted / r["n"])) for r in counts],
        "lang string, least long, share double",
    )
    part = F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = (
        rows.join(F.broadcast(shares), "lang")
        .where((part < F.col("share")) | (F.col("draw") == F.col("least")))
        .groupBy("lang", "draw")  # repeated rows count once
        .agg(F.first("text").alias("text"), F.first(F.col("draw") != F.col("least")).alias("further"))
        .orderBy("further", "draw", "lang")
        .limit((2 * wanted + 1) * len(counts))
    )
    return [(r["text"], r["lang"]) for r in picked.select("text", "lang").collect()]


def learned(documents: DataFrame, held_out: Column) -> LanguageModel:
    return fit(sample(documents.where(~held_out)))


def _judge(labeller: Labeller, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and share of each text."""
    languages = labeller.model.languages
    if not languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    shares = labeller.shares(texts)
    score = np.clip(shares.max(axis=1, initial=0.0), 0, 1)
    best = shares.argmax(axis=1)
    return [languages[b] if s > 0 else UNDETERMINED for b, s in zip(best, score)], score


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``.

    ``score`` is the share of the language in the text.  A null text, one without a letter,
    and any text if nothing could be learned get ``und`` and 0.  Of equal shares the first
    language by name counts.  Only the text is used.  Rows are labelled each on their own.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(model)  # its size grows with the languages only

    def start():
        labeller = shipped.value.labeller()

        def step(batch: pa.RecordBatch) -> dict:
            languages, scores = [], [np.zeros(0)]
            for part in _slices(batch, batch.schema.names.index("text")):
                found, score = _judge(labeller, part.column("text").to_pylist())
                languages += found
                scores.append(score)
            return {"doc_id": batch.column("doc_id"), "lang_pred": languages, "score": np.concatenate(scores)}

        return step

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return map_batches(rows, "doc_id long, lang_pred string, score double", start)


def with_language(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows, whole, that ``identify`` does not give ``und``; all rows if nothing could be learned.

    Rows without a ``lang`` get the one that is found.  However evenly a text mixes languages, it
    stays.  The decision needs the row alone, so there is no join.
    """
    if not model.languages:
        return documents
    shipped = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")
    lang = documents.columns.index("lang") if "lang" in documents.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shipped.value.labeller()
        for batch in batches:
            for part in _slices(batch, at):
                found, _ = _judge(labeller, [t or "" for t in part.column(at).to_pylist()])
                if lang is not None and part.column(lang).null_count:
                    whole = pc.coalesce(part.column(lang), pa.array(found, part.column(lang).type))
                    part = part.set_column(lang, part.schema.field(lang), whole)
                yield part.filter(pa.array([x != UNDETERMINED for x in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def remainder() -> Column:
    """The fold of a document: the CRC-32 of its id as text (null: empty) modulo 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5


def identify_languages(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``, by a model of those not
    held out.  See ``identify``."""
    model = learned(documents, remainder() == 0)
    return identify(documents, model).select("doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score")

"""Language identification of whole texts, also code-switched ones, by a conditional random field on their words."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.crf import ENDS, TOKENS, Labeller, Model, pieces
from txrisk.llm.crf import train as train_crf
from txrisk.llm.memory import tidy
from txrisk.llm.tables import column, extended

#: The sample that the model learns from: documents of each language and sentences of each document. These bound it.
TRAIN_DOCS = 1200
TRAIN_SENTENCES = 4
#: Words of a training chain at most, and the share of chains that change language.
TRAIN_WORDS = 24
SWITCHED = 0.3
UNDETERMINED = "und"


def _sentences(text: str, wanted: int, seed: int) -> list[list[str]]:
    """Sentences of a text chosen at random over all of it, reproducibly, in lower case."""
    found, words = [], []
    for piece in pieces(text):
        for token in [*TOKENS.findall(piece), "\n"]:
            if token not in ENDS:
                words.append(token.lower())
            if words and (token in ENDS or len(words) >= TRAIN_WORDS):
                found.append(words)
                words = []
    return found if len(found) <= wanted else random.Random(seed).sample(found, wanted)


def sample(labelled: DataFrame, per_label: int = TRAIN_DOCS, sentences: int = TRAIN_SENTENCES) -> list[tuple[str, list[str]]]:
    """About ``per_label`` different texts of every language (columns ``text, lang``, rows with a NULL left out), by a hash of the
    text and language with a rate that follows the language's estimated count of different texts, and some sentences of each.

    At most ``2 * per_label`` texts for each language come to the driver, the first by the hash, whatever the size of the table.
    """
    rows = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    if not counts:
        return []
    rate = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_label / n))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("lang", "text", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [[" ".join(x) for x in _sentences(text, sentences, len(text))] for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["drawn"], pa.array(words, pa.list_(pa.string()))], ["lang", "drawn", "words"])

    different = rows.withColumn("drawn", drawn).filter(F.col("drawn") < rate).dropDuplicates(["lang", "text"])
    chosen = different.select("lang", "drawn", "text").mapInArrow(cut, "lang string, drawn double, words array<string>")
    order = Window.partitionBy("lang").orderBy("drawn", "words")
    chosen = chosen.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2 * per_label)
    return sorted((r["lang"], words.split(" ")) for r in chosen.collect() for words in r["words"])


def train(sentences: list[tuple[str, list[str]]], seed: int = 1) -> Model | None:
    """A model from labelled sentences; None without any. Some chains are halves of sentences of two languages, from
    which the field learns how seldom neighbours differ."""
    labels = sorted({lang for lang, _ in sentences})
    if not labels:
        return None
    dice, number = random.Random(seed), {lang: i for i, lang in enumerate(labels)}
    order = sentences[:]
    dice.shuffle(order)
    chains = []
    for (lang, words), (other, more) in zip(order, order[1:] + order[:1]):
        if dice.random() < SWITCHED and lang != other:
            words, more = words[: len(words) // 2 + 1], more[len(more) // 2 :]
            chains.append((words + more, [number[lang]] * len(words) + [number[other]] * len(more)))
        else:
            chains.append((words, [number[lang]] * len(words)))
    return train_crf(chains, labels)


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``lang_pred, score, n_words`` beside the columns ``keep`` of ``docs``, from its column ``text`` alone, which may be a field of
    a struct in ``keep`` (``row.text``).

    Every word gets label probabilities by forward-backward over its chain (a sentence, cut after 48 words); a text's
    language is the one with the largest sum, ties going to the first by name, and ``score`` its share of all. Texts that are
    NULL or have no letter, and all texts if there is no model, are ``und`` with score 0 (of 0 words). One pass without a
    shuffle; a task holds one batch of rows and the chains of about 100,000 words.
    """
    kept = docs.select(*keep, *([] if "." in text else [text]))

    @tidy
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model else None
        for batch in batches:
            texts = column(batch, text).to_pylist()
            sums = labeller.sums(texts) if labeller else np.zeros((len(texts), 1))
            total, best = sums.sum(1), sums.argmax(1)
            names = [model.labels[b] if t > 0 else UNDETERMINED for b, t in zip(best, total)]
            score = np.where(total > 0, sums.max(1) / np.maximum(total, 1e-9), 0.0)
            made = [pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(np.rint(total).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *made], [*keep, "lang_pred", "score", "n_words"])

    return kept.mapInArrow(label, extended(kept, keep, "lang_pred string, score double, n_words long"))

"""Language identification by prediction with partial matching.

Per language a variable-order context tree over bytes holds how often each
symbol followed each context of up to ``ORDER`` symbols.  The code length of a
symbol is that of the longest known context: ``-log2(c / (n + d))`` where the
symbol was seen ``c`` times among ``n`` with ``d`` different ones, else the
escape ``-log2(d / (n + d))`` plus its length in the next shorter context, down
to a uniform code.  A text is given to the language that codes it shortest.

After fitting, the statistics are frozen, so the length of a symbol depends on
its last ``ORDER`` predecessors alone.  Each tree is therefore laid out as a
table of the lengths of all ``ALPHABET ** (ORDER + 1)`` strings, and scoring a
whole text is one table look-up per byte and language, summed exactly.

The alphabet: letters without case, blanks and control characters as one byte,
digits as one.  Per language the ``ALPHABET - 1`` most frequent of these bytes
are symbols of their own and all others one symbol, after which an escape codes
which byte it was, from its counts in the language; so every byte has its code
length in every language, whatever the script.

Bounds.  Trees are fitted on at most ``sample`` distinct labelled texts per
language, those of the smallest hashes, so it is the same sample on every
cluster, copies weigh nothing and every language with a text is learned.
One table takes 10 MB.  The driver holds 2 KB per language; counts stay in a
written table, from which ``BLOCK`` languages at a time are laid out and
broadcast, and more languages are scored in further passes over a written table.

Defined results: a null text, a text without a letter, and every text when
nothing could be learned is ``und`` with score 0; ties go to the smaller
language name; repeated rows are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Slice, crc_fold, plain_names, text_slices, written

ALPHABET = 40
ORDER = 3
BLOCK = 8
SAMPLE = 3000
NONE = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:33] = 32
_FOLD[127] = 32
_FOLD[65:91] += 32
_FOLD[48:58] = 48


def _histogram(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        names = np.array(batch.column(1).to_pylist(), dtype=object)
        for part in text_slices(batch.column(0)):
            langs = names[part.first : part.last]
            owner = np.repeat(np.arange(len(langs)), np.diff(part.offsets))
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + np.bincount(_FOLD[part.data[langs[owner] == lang]], minlength=256)
    for lang, n in total.items():
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["lang", "byte", "n"])


def alphabet(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the counts of folded bytes in a language: the symbol of every byte,
    and the bits that tell which byte an ``ALPHABET - 1`` stands for."""
    ranked = sorted(np.flatnonzero(counts).tolist(), key=lambda b: (b != 32, -counts[b], b))[: ALPHABET - 1]
    own = np.full(256, ALPHABET - 1, np.int32)
    own[32] = 0
    for k, b in enumerate(ranked):
        own[b] = k
    rare = np.zeros(256, bool)
    rare[np.unique(_FOLD)] = True
    rare &= own == ALPHABET - 1
    c = np.where(rare, counts, 0)
    total, kinds = c.sum(), (c > 0).sum()
    bits = np.zeros(256)
    if rare.any():
        unseen = np.log2(max(1, rare.sum()))
        escaped = unseen - np.log2(kinds / (total + kinds)) if total else unseen
        bits[rare] = escaped
        bits[c > 0] = -np.log2(c[c > 0] / (total + kinds))
    return own[_FOLD], bits[_FOLD].astype(np.float32)


def strings(part: Slice, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte the number of the string of its ORDER predecessors and itself;
    texts start after blanks.  Also the first index of every text."""
    lengths = np.diff(part.offsets)
    space = int(symbols[32])
    padded = np.full(len(part.data) + ORDER * len(lengths), space, np.int32)
    at = np.arange(len(part.data)) + np.repeat(ORDER * np.arange(1, len(lengths) + 1), lengths)
    padded[at] = symbols[part.data]
    number = padded.copy()
    for k in range(1, ORDER + 1):
        number[ORDER:] += padded[ORDER - k : len(padded) - k] * np.int32(ALPHABET**k)
    return number[at], part.offsets[:-1]


def _occurrences(batches, symbols: dict[str, np.ndarray]):
    for batch in batches:
        names = np.array(batch.column(1).to_pylist(), dtype=object)
        for part in text_slices(batch.column(0)):
            langs = names[part.first : part.last]
            owner = np.repeat(np.arange(len(langs)), np.diff(part.offsets))
            for lang in sorted(set(langs)):
                number, _ = strings(part, symbols[lang])
                found, n = np.unique(number[langs[owner] == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(n, pa.int64())], ["lang", "string", "n"])


def code_lengths(strings_seen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The flattened tree: bits of the last symbol of every string."""
    counts = np.zeros(ALPHABET ** (ORDER + 1))
    counts[strings_seen] = n
    counts = counts.reshape((ALPHABET,) * (ORDER + 1))
    bits = np.full(ALPHABET, np.log2(ALPHABET))
    for order in range(ORDER + 1):
        c = counts.sum(axis=tuple(range(ORDER - order)))
        total, kinds = c.sum(axis=-1, keepdims=True), (c > 0).sum(axis=-1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            coded = -np.log2(c / (total + kinds))
            escaped = -np.log2(kinds / (total + kinds)) + bits
        bits = np.where(total == 0, bits, np.where(c > 0, coded, escaped))
    return bits.astype(np.float32).ravel()


class Model:
    """Language names in order, per language the symbols of bytes and the bits
    of its rare bytes, and the table (lang, string, n) of counted strings."""

    def __init__(self, letters: dict[str, tuple[np.ndarray, np.ndarray]], counts: DataFrame):
        self.languages = sorted(letters)
        self.letters = letters
        self.counts = counts

    def laid_out(self, languages: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Symbols, rare bits and table of code lengths of some languages, one block of them."""
        held = dict(list(self.counts.where(F.col("lang").isin(languages)).toPandas().groupby("lang")))
        return [(*self.letters[x], code_lengths(held[x]["string"].to_numpy(), held[x]["n"].to_numpy())) for x in languages]

    def blocks(self) -> list[list[str]]:
        return [self.languages[k : k + BLOCK] for k in range(0, len(self.languages), BLOCK)]

    @property
    def parts(self):
        """The same of all languages in turn, a block in memory at a time."""
        for languages in self.blocks():
            yield from self.laid_out(languages)


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of ``docs``: all rows given are training rows."""
    usable = docs.select(docs[text].cast("string").alias("text"), docs[lang].cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    hashed = usable.withColumn("hash", F.xxhash64("text"))
    distinct = hashed.select("lang", "hash").distinct()
    sizes = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod("hash", F.lit(1 << 30)) / F.lit(1 << 30)
    near = place < F.lit(2.0 * sample + 100) / F.col("n")  # a few more than the sample, however large the language
    order = Window.partitionBy("lang").orderBy(place, "hash")
    taken = distinct.join(sizes, "lang").where(near).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample).select("lang", "hash")
    chosen = hashed.join(written(taken, "language-hashes"), ["lang", "hash"]).groupBy("lang", "hash").agg(F.min("text").alias("text"))
    chosen = written(chosen.select("text", "lang"), "language-sample")
    histogram = chosen.mapInArrow(_histogram, "lang string, byte int, n long").groupBy("lang", "byte").agg(F.sum("n").alias("n")).toPandas()
    letters = {}
    for name, part in histogram.groupby("lang"):
        counts = np.zeros(256, np.int64)
        counts[part["byte"].to_numpy()] = part["n"].to_numpy()
        letters[name] = alphabet(counts)
    symbols = {name: own for name, (own, _) in letters.items()}
    seen = chosen.mapInArrow(lambda rows: _occurrences(rows, symbols), "lang string, string int, n long").groupBy("lang", "string").agg(F.sum("n").alias("n"))
    return Model(letters, written(seen.sortWithinPartitions("lang"), "language-counts"))


def _score(batches, model, text_at: int, drop: bool):
    held = model.value
    for batch in batches:
        bits = np.zeros((batch.num_rows, len(held)))
        for part in text_slices(batch.column(text_at)):
            full = np.diff(part.offsets) > 0
            if not full.any():
                continue
            for k, (symbols, rare, table) in enumerate(held):
                number, first = strings(part, symbols)
                bits[part.first : part.last, k][full] = np.add.reduceat(table[number] + rare[part.data], first[full], dtype=np.float64)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(held)), pa.array(bits.ravel()))
        earlier = batch.schema.get_field_index("_bits")
        if earlier >= 0:
            rows = pa.array([[*a, *b] for a, b in zip(batch.column(earlier).to_pylist(), rows.to_pylist(), strict=True)], pa.list_(pa.float64()))
        keep = [k for k in range(batch.num_columns) if k != earlier and not (drop and k == text_at)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), rows], [*(batch.schema.names[k] for k in keep), "_bits"])


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep_text: bool = True, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its probability if each text's
    code lengths are read as likelihoods, in columns of the given ``names``."""
    pred, chance = names
    spark = docs.sparkSession
    if not model.languages:
        out = docs if keep_text else docs.drop(text)
        return out.withColumn(pred, F.lit(NONE)).withColumn(chance, F.lit(0.0))
    body = docs[text].cast("string")
    scored = docs.withColumn("_letters", F.coalesce(body.rlike(r"\p{L}"), F.lit(False)))
    at = scored.columns.index(text)
    blocks = model.blocks()
    for k, languages in enumerate(blocks):
        last = k + 1 == len(blocks)
        held = spark.sparkContext.broadcast(model.laid_out(languages))
        drop = last and not keep_text
        fields = [f for f in scored.schema.fields if f.name != "_bits" and not (drop and f.name == text)]
        schema = T.StructType([*fields, T.StructField("_bits", T.ArrayType(T.DoubleType()))])
        scored = scored.mapInArrow(lambda rows, held=held, drop=drop: _score(rows, held, at, drop), schema)
        if not last:
            scored = written(scored, "language-bits")
            held.destroy()
    least = F.array_min("_bits")
    weight = F.aggregate("_bits", F.lit(0.0), lambda total, b: total + F.pow(F.lit(2.0), F.greatest(least - b, F.lit(-1000.0))))
    named = F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.array_position("_bits", least).cast("int"))
    return (
        scored.withColumn(pred, F.when(F.col("_letters"), named).otherwise(NONE))
        .withColumn(chance, F.when(F.col("_letters"), 1.0 / weight).otherwise(0.0))
        .drop("_bits", "_letters")
    )


def held_out_identification(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows outside the held-out fold, predict all of them."""
    fold = crc_fold(doc_id, 4) == 2
    model = fit(docs.where(~fold), text=text, lang=lang)
    picked = docs.select(docs[doc_id].alias("doc_id"), fold.alias("held_out"), docs[text].cast("string").alias("text"))
    return identify(picked, model, keep_text=False).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """Documents with a language of at least that probability, columns unchanged whatever their names."""
    plain, names = plain_names(docs)
    judged = identify(plain, model, text=names[text], names=("_lang_pred", "_lang_score"))
    kept = judged.where((F.col("_lang_pred") != NONE) & (F.col("_lang_score") >= least))
    return kept.select(*names.values()).toDF(*docs.columns)

"""Fill-in-middle transformation by counted quantifiers.

A text falls into ``n`` units, "white space, then the rest of a word" or white
space at the end, which ``regexp_count`` counts.  (That function lists the
matches before it counts them, some hundred bytes each; in texts above ``LONG``
bytes each unit is replaced by one character and those are counted, which gives
the same number in memory of the text's own size.)  Two cuts are drawn from a
hash of seed and id; a pattern made for the row, ``(unit{a})(unit{b-a})(rest)``
with possessive quantifiers, then captures prefix, middle and suffix in one match.
Possessive groups are matched in a loop without a stack of choices, so the
length of a text is no limit.  Everything is column expressions: one scan, no
shuffle, no Python.

The captures are joined by a marker and split again.  No transformed text holds
a marker (such texts stay plain) and a marker's first character stands nowhere
else in it, so none can arise across a seam, and the same holds for the output:
splitting it at the markers gives the parts back exactly.

Defined results: a null text counts as empty; empty texts, texts with a marker
and texts outside the drawn share stay as they are (form ``plain``); a null id
draws as the text ''; rows of one id draw the same cuts, each on its own text;
other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
UNIT = f"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_ANY = "<[PSM]>"
LONG = 1 << 20


def draw(seed: int, doc_id: Column, k: int) -> Column:
    """The ``k``-th (from 0) 32-bit number drawn for a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def count_units(text: Column) -> Column:
    """The number of units of a text."""
    listed = F.regexp_count(text, F.lit(UNIT))
    return F.when(F.octet_length(text) <= LONG, listed).otherwise(F.char_length(F.regexp_replace(text, UNIT, "."))).cast("long")


def parts_of(text: Column, first: Column, second: Column) -> Column:
    """[prefix, middle, suffix]: the units before ``first``, up to ``second``, and the rest."""
    pattern = F.concat(
        F.lit(rf"(?s)\A((?:{UNIT}){{"), first.cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"), (second - first).cast("string"), F.lit(r"}+)(.*+)\z")
    )
    return F.split(F.regexp_replace(text, pattern, F.lit(f"$1{MIDDLE}$2{MIDDLE}$3")), MIDDLE, 3)


def restore(output: Column, form: Column) -> Column:
    """The text an output was made of."""
    parts = F.split(output, _ANY, 4)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def fill_in_middle(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars, output.

    ``rate`` percent of the documents are transformed, ``spm`` percent of those
    in the order suffix, prefix, middle.
    """
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[doc_id].alias("doc_id"), body.alias("text"), *(draw(seed, docs[doc_id], k).alias(f"h{k}") for k in range(4)))
    plain = (F.col("text") == "") | F.col("text").rlike(_ANY) | (F.col("h2") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h3") % 100 < spm, "spm").otherwise("psm")
    counted = rows.withColumn("n", count_units(F.col("text"))).withColumn("form", form)
    one, two = F.col("h0") % (F.col("n") + 1), F.col("h1") % (F.col("n") + 1)
    cut = counted.withColumn("parts", F.when(F.col("form") != "plain", parts_of(F.col("text"), F.least(one, two), F.greatest(one, two))))
    part = F.col("parts")
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), part[0], F.lit(SUFFIX), part[2], F.lit(MIDDLE), part[1]))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), part[2], F.lit(PREFIX), part[0], F.lit(MIDDLE), part[1]))
        .otherwise(F.col("text"))
    )
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.char_length(part[0]).cast("long").alias("prefix_chars"),
        F.char_length(part[1]).cast("long").alias("middle_chars"),
        output.alias("output"),
    )


def fill_in_middle_digest(docs: DataFrame, **options) -> DataFrame:
    """The transformation with digests of its output and of the text rebuilt from it."""
    made = fill_in_middle(docs, **options)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )

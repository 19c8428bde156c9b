"""Exact token counts at every prefix by dynamic programming.

In byte-pair encoding every prefix of a text has exactly one encoding, and its
last token fixes the rest: the encoding of ``s[:i]`` is that of ``s[:i - l]``
plus one token of length ``l``, for the only ``l`` whose token can stand after
the last token of ``s[:i - l]`` -- that is, the pair of them, encoded on its
own, stays that pair.  So one pass over the positions stores the last token and
the count of every prefix; no text is encoded again to answer how many tokens
its first ``i`` characters have, or where a budget of ``n`` tokens ends.

Merges never cross from a non-blank to a blank here (no piece of the vocabulary
has a blank after anything else), so a text falls into runs "blanks, then
non-blanks" that are independent.  A run that ends in a mark (".", ",") is its
word with one prefix more, unless some piece ends in the two characters at the
seam; so words with and without a mark share an entry.  Totals of frequent runs
are kept per worker in a bounded cache of two generations.

Defined results: a null text counts as empty; an empty text has 0 tokens; rows
are independent; long texts cost time in proportion to their length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Recent

BLANK = "▁"
CACHE = 300_000  # runs in each of two generations, and pairs of tokens
MARKS = ".,;:!?"
KEEP = 48  # longer runs are not kept
_RUNS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_TABLES: dict[str, PrefixCounts] = {}


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounts:
    """Prefix token counts under a sentencepiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("a piece has a blank after a non-blank: runs are not independent")
        self.ends = {p[k:] for p in self.score for k in range(len(p))}
        self.whole: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.totals = Recent(CACHE)
        self.back: dict[str, list] = {}  # pieces from their last character to their first: [piece or None, next]
        for piece in self.score:
            level = self.back
            for char in reversed(piece):
                node = level.setdefault(char, [None, {}])
                level = node[1]
            node[0] = piece

    def merge(self, text: str) -> list[str]:
        """Plain BPE of a short string: the best-scored pair first, leftmost on ties."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _is_token(self, piece: str) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = len(piece) == 1 or (piece in self.score and self.merge(piece) == [piece])
        return known

    def _fits(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def table(self, run: str) -> list[int]:
        """Token counts of every prefix of a run, from the empty one on."""
        back, score, whole, pairs = self.back, self.score, self.whole, self.pairs
        counts, last = [0], [""]
        for i in range(1, len(run) + 1):
            at, level, found = i, back, []
            while at:  # every piece that ends here, shortest first
                node = level.get(run[at - 1])
                if node is None:
                    break
                at -= 1
                if node[0] is not None:
                    found.append(node[0])
                level = node[1]
            while found:
                piece = found.pop()
                known = whole.get(piece)
                if not (self._is_token(piece) if known is None else known):
                    continue
                before = i - len(piece)
                if not before:
                    break
                known = pairs.get((last[before], piece))
                if self._fits(last[before], piece) if known is None else known:
                    break
            else:
                piece = run[i - 1]  # in no piece: spelled in bytes
            last.append(piece)
            counts.append(counts[i - len(piece)] + (1 if piece in score else len(piece.encode())))
        return counts

    def total(self, run: str) -> int:
        known = self.totals.get(run)
        if known is None:
            if len(run) > 2 and run[-1] in MARKS and run[-2:] not in self.ends:
                known = self.total(run[:-1]) + (1 if run[-1] in self.score else len(run[-1].encode()))
            else:
                known = self.table(run)[-1]
            if len(run) <= KEEP:
                self.totals.put(run, known)
        return known

    @staticmethod
    def runs(text: str) -> list[str]:
        """The independent runs of a text; line ends stand in no piece, so they start runs too."""
        if not text:
            return []
        spelled = (BLANK + text.replace(" ", BLANK)).replace("\n", "\0\n")
        return [run for line in spelled.split("\0") for run in _RUNS.findall(line)] if "\0" not in text else _RUNS.findall(spelled.replace("\0\n", "\n"))

    def sized(self, text: str) -> tuple[list[str], list[int]]:
        """The runs of a text and the tokens of each."""
        runs = self.runs(text)
        sizes = list(map(self.totals.young.get, runs))
        if None in sizes:
            sizes = [n if n is not None else self.total(run) for n, run in zip(sizes, runs, strict=True)]
        return runs, sizes

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return sum(self.sized(text)[1])

    def cut(self, text: str, budget: int) -> int:
        """Characters in the longest prefix of at most ``budget`` tokens."""
        return self.cut_runs(*self.sized(text), budget)

    def cut_runs(self, runs: list[str], sizes: list[int], budget: int) -> int:
        """The same, of a text given as its runs and their tokens."""
        upto = list(accumulate(sizes, initial=0))
        whole = bisect_right(upto, budget) - 1  # runs that fit
        at = sum(map(len, runs[:whole])) - 1  # the leading blank of the spelling is not in the text
        if whole < len(runs):
            table = self.table(runs[whole])
            at += max(k for k, c in enumerate(table) if upto[whole] + c <= budget)
        return max(0, at)


def _counter(path: str) -> PrefixCounts:
    if path not in _TABLES:
        _TABLES[path] = PrefixCounts(path)
    return _TABLES[path]


def _count(batches, vocabulary: str, budget: int):
    counter = _counter(vocabulary_path(vocabulary))
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        cut = np.zeros(batch.num_rows, np.int64)
        for k, text in enumerate(batch.column(1)):
            text = text.as_py() or ""
            runs, sizes = counter.sized(text)
            size[k] = sum(sizes)
            cut[k] = counter.cut_runs(runs, sizes, budget) if size[k] > budget else len(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size), pa.array(cut)], ["doc_id", "n_bytes", "n_tokens", "cut_chars"])


def token_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "piece_bpe_32k.model", budget: int = 4096) -> DataFrame:
    """Per document: n_bytes, n_tokens, over_limit, and ``cut_chars``, the
    length of its longest prefix within ``budget`` tokens."""
    body = docs[text].cast("string")
    picked = docs.select(docs[doc_id].alias("doc_id"), body.alias("text"), F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    counted = picked.mapInArrow(lambda rows: _count(rows, vocabulary, budget), f"doc_id {kind}, n_bytes long, n_tokens long, cut_chars long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "cut_chars")

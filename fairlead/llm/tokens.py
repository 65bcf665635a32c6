"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary file is read for its merges alone. A text is normalised and cut into pieces as the file says; a piece's symbols are the nodes of a linked list, its adjacent mergeable pairs lie in a heap by rank. The lowest is popped and merged, the new neighbours are pushed, until none is left. A piece's count is its symbols less the merges; identifiers are never made.

Pieces repeat, so counts are kept by piece in a table of bounded size in each task.

Defined results: a null or empty text has 0 bytes and 0 tokens. Special strings inside texts count as one token each, as the file's library has it by default; a file with a special string that does not begin with ``<|``, with other normalisers or ways of splitting, or whose replacement is not that of white space by a space, is refused. Repeated rows give repeated rows; extra columns are kept unless named like an output. A text of any length is counted whole, piece by piece.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows

#: Pieces whose counts a task keeps, in each of two generations: when the younger is full it becomes the older.
KEPT_PIECES = 400_000

FIELDS = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]


def count_merges(symbols: list[int], ranks: dict[int, tuple[int, int]]) -> int:
    """Tokens of one piece: len(symbols) less the merges made. ``ranks`` gives each mergeable pair, as left << 20 | right, its rank and the symbol it makes.

    The heap holds rank << 32 | place. An entry is stale, and passed over, if the pair at its place no longer has its rank.
    """
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [r[0] << 32 | i for i in range(n - 1) if (r := ranks.get(symbols[i] << 20 | symbols[i + 1]))]
    heapq.heapify(heap)
    merged = 0
    while heap:
        top = heapq.heappop(heap)
        i = top & 0xFFFFFFFF
        j = after[i]
        if j < 0 or symbols[i] < 0:
            continue
        pair = ranks.get(symbols[i] << 20 | symbols[j])
        if pair is None or pair[0] != top >> 32:
            continue
        symbols[i], symbols[j] = pair[1], -1
        merged += 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if r := ranks.get(symbols[i] << 20 | symbols[k]):
                heapq.heappush(heap, r[0] << 32 | i)
        if (h := before[i]) >= 0 and (r := ranks.get(symbols[h] << 20 | symbols[i])):
            heapq.heappush(heap, r[0] << 32 | h)
    return n - merged


#: A stop or comma between a letter and white space, which is a piece of its own anyway: apart, it leaves the word before it as one that is known.
_STOP = re.compile(r"(?<=[^\W\d_])([.,])(?=[ \n])")


class Kept(dict):
    """Counts by chunk in two generations; one that is missing is made and kept."""

    def __init__(self, make) -> None:
        self.make, self.old = make, {}

    def __missing__(self, chunk: str) -> int:
        got = self.old.get(chunk)
        if got is None:
            got = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= KEPT_PIECES:
                self.old = dict(self)
                self.clear()
            self[chunk] = got
        return got


class WordBpe:
    """Counts for a ``tokenizers`` BPE file that normalises by NFC, white space and lower case, splits by a pattern and marks word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain BPE file")
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: normalizers {steps} are not supported")
        blank = spec["normalizer"]["normalizers"][1]
        if blank["pattern"] != {"Regex": "\\s+"} or blank["content"] != " ":
            raise ValueError(f"{path}: this way of replacing is not supported")
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] or level["type"] != "ByteLevel" or level["use_regex"]:
            raise ValueError(f"{path}: this way of splitting is not supported")
        self.pieces = regex.compile(split["pattern"]["Regex"], regex.V0)
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]]
        letters = [chr(c) for c in byte_letters()]
        symbol: dict[str, int] = {}
        number = lambda x: symbol.setdefault(x, len(symbol))
        self.inner = [number(x) for x in letters]
        self.last = [number(x + self.end) for x in letters]
        self.ranks = {number(a) << 20 | number(b): (i, number(a + b)) for i, (a, b) in enumerate(pairs)}
        special = sorted((x["content"] for x in spec["added_tokens"] if not x["normalized"]), key=len, reverse=True)
        if not all(x.startswith("<|") for x in special):
            raise ValueError(f"{path}: special strings {special} are not supported")
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.kept = Kept(self._chunk)

    def piece(self, piece: str) -> int:
        """Tokens of one normalised piece."""
        data = piece.encode("utf-8", "replace")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return count_merges(symbols, self.ranks)

    def _chunk(self, chunk: str) -> int:
        """Tokens between two plain spaces: no piece crosses white space."""
        pieces = self.pieces.findall(chunk)
        return self.piece(chunk) if pieces == [chunk] else sum([self.kept[x] for x in pieces])

    def _plain(self, text: str) -> int:
        # Lower case goes letter by letter: a final sigma is not a case of its own.
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        text = _STOP.sub(r" \1", text)
        return sum(map(self.kept.__getitem__, text.replace("\n", " ").split(" ")))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or "<|" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def byte_letters() -> list[int]:
    """The printable code point that stands for each byte: itself if it is visible in Latin-1, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    shown = set(visible)
    return [b if b in shown else next(spare) for b in range(256)]


def count_tokens(docs: DataFrame, vocabulary: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8) and n_tokens of each text. ``vocabulary`` is a path that every executor can read."""

    def make():
        bpe = WordBpe(vocabulary)
        return lambda texts: {"n_bytes": [len((t or "").encode("utf-8", "surrogatepass")) for t in texts], "n_tokens": [bpe.count(t) for t in texts]}

    return map_rows(docs, text_col, FIELDS, make)

"""Merge-type SentencePiece encoding and decoding.

A text becomes symbols, one per character, with spaces as ``▁`` and one in front.  An agenda holds
the adjacent pairs that are pieces, best score first and leftmost among equals; taking a pair merges
it and adds its new neighbours.  What is no piece in the end is spelled in bytes.

No piece has ``▁`` after another character, so pairs never merge across the start of a word and a
text is encoded word by word; words seen before come from a bounded memory.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Words that a task remembers; beyond that it starts afresh.
MEMORY = 500_000
#: Words of up to these lengths are encoded side by side, longer ones on their own.
SHORT = (8, 16, 40)
#: So many words are encoded and checked at once: what stands in memory meanwhile does not grow with a batch.
_AT_ONCE = 2_000
#: More than there are symbols: pieces and all code points.
_NUMBERS = 1 << 22


class Vocabulary:
    """Pieces and scores of a merge-type model file with identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.vocab_size()
        self.ids: dict[str, int] = {}
        self.scores: list[float] = [0.0] * size
        self.surface: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        for i in range(size):
            piece = library.id_to_piece(i)
            self.scores[i] = library.get_score(i)
            if library.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface[i] = bytes([value])
            elif not (library.is_control(i) or library.is_unknown(i)):
                self.ids[piece] = i
                self.surface[i] = piece.replace(SPACE, " ").encode()
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.cost = {p: -self.scores[i] for p, i in self.ids.items()}
        self._number_symbols()
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans the start of a word")

    def _number_symbols(self) -> None:
        """Symbols as numbers, for many words at once: pieces by ID, other characters behind them.

        ``_pairs`` are the pairs of symbols that make a piece, in order; ``_makes`` and ``_costs``
        say which and at what cost.
        """
        size = len(self.scores)
        self._of_char = np.arange(size, size + 0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self._of_char[ord(piece)] = i

        def number(symbol: str) -> int | None:
            return self.ids.get(symbol) if len(symbol) > 1 else int(self._of_char[ord(symbol)])

        rows = []
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                left, right = number(piece[:at]), number(piece[at:])
                if left is not None and right is not None:
                    rows.append((left * _NUMBERS + right, i))
        rows.sort()
        self._pairs = np.array([k for k, _ in rows] or [-1], np.int64)
        self._makes = np.array([i for _, i in rows] or [0], np.int64)
        self._costs = np.array([-self.scores[i] for _, i in rows] or [np.inf])

    def _offers(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost and piece of each pair of symbols; an endless cost where they make none."""
        wanted = left * _NUMBERS + right
        at = np.searchsorted(self._pairs, wanted)
        at[at == len(self._pairs)] = 0
        hit = self._pairs[at] == wanted
        return np.where(hit, self._costs[at], np.inf), self._makes[at]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """IDs of many words as 32-bit numbers, by an agenda per word, a row of an array.

        In every round each row takes its best pair, the leftmost of equals, until none is left.
        """
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in zip((0, *SHORT[:-1]), SHORT, strict=True):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(chosen), _AT_ONCE):
                some = chosen[at:at + _AT_ONCE]
                for i, ids in zip(some.tolist(), self._encode_rows([words[i] for i in some], high), strict=True):
                    out[i] = ids
        for i in np.flatnonzero(sizes > SHORT[-1]).tolist():
            ids = self.encode_word(words[i])
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _encode_rows(self, words: list[str], width: int) -> list[bytes]:
        n, size = len(words), len(self.scores)
        length = np.fromiter(map(len, words), np.int64, n)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.full((n, width + 1), _NUMBERS - 1, np.int64)
        symbols[np.arange(width + 1) < length[:, None]] = self._of_char[chars]
        cost, makes = self._offers(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(n)
        columns = np.arange(width)
        while len(rows):
            best = cost[rows].argmin(axis=1)
            rows, best = (x[np.isfinite(cost[rows, best])] for x in (rows, best))
            if not len(rows):
                break
            symbols[rows, best] = makes[rows, best]
            length[rows] -= 1
            # what is behind the merged pair moves up
            behind = columns + (columns > best[:, None])
            symbols[rows, :-1] = np.take_along_axis(symbols[rows], behind, axis=1)
            behind = np.minimum(columns + (columns >= best[:, None]), width - 1)
            for grid in (cost, makes):
                grid[rows] = np.take_along_axis(grid[rows], behind, axis=1)
            cost[rows, -1] = np.inf
            for at in (best, best - 1):
                inside = at >= 0
                r, c = rows[inside], at[inside]
                cost[r, c], makes[r, c] = self._offers(symbols[r, c], symbols[r, c + 1])
        flat = symbols[np.arange(width + 1) < length[:, None]]
        ends = np.cumsum(length)
        raw = flat.astype("<u4").tobytes()
        out = [raw[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), length.tolist(), strict=True)]
        # characters that are no piece are spelled in bytes
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(flat >= size), "right"))
        for i in odd.tolist():
            ids: list[int] = []
            for v in flat[ends[i] - length[i]:ends[i]].tolist():
                if v < size:
                    ids.append(v)
                else:
                    ids += [self.byte_ids[b] for b in chr(v - size).encode("utf-8", "replace")]
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _merged(self, word: str) -> list[str]:
        """The agenda as a heap: a long word takes no quadratic time."""
        cost, push, pop = self.cost.get, heapq.heappush, heapq.heappop
        text = list(word)
        n = len(text)
        agenda = []
        for i in range(1, n):
            pair = text[i - 1] + text[i]
            c = cost(pair)
            if c is not None:
                agenda.append((c, i - 1, i, pair))
        heapq.heapify(agenda)
        # neighbours of each symbol; n stands for none behind, -1 for none before
        before, after = list(range(-1, n)), list(range(1, n + 2))
        text.append("")
        while agenda:
            _, left, right, pair = pop(agenda)
            # a symbol that changed since makes the entry void
            if after[left] != right or text[left] + text[right] != pair:
                continue
            behind = after[right]
            text[left], text[right] = pair, ""
            after[left], before[behind], after[right] = behind, left, -1
            for i, j in ((left, behind), (before[left], left)):
                if i >= 0 and j < n:
                    joined = text[i] + text[j]
                    c = cost(joined)
                    if c is not None:
                        push(agenda, (c, i, j, joined))
        return [symbol for symbol in text if symbol]

    def encode_word(self, word: str) -> list[int]:
        """IDs of one word by the agenda of adjacent pairs."""
        text = self._merged(word)
        out: list[int] = []
        known = self.ids.get
        for symbol in text:
            found = known(symbol)
            if found is not None:
                out.append(found)
            else:
                out += [self.byte_ids[b] for b in symbol.encode("utf-8", "replace")]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text without the space in front; control IDs say nothing."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        raw = raw[1:] if raw[:1] == b" " else raw
        return raw.decode("utf-8", "replace")


def words_of(text: str) -> list[str]:
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Encoder:
    """Encodes texts; checks each word it meets against the library, a batch in one call."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.vocabulary = Vocabulary(path)
        self.memory = memory
        self.known: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """IDs with begin and end."""
        if len(self.known) > self.memory:
            self.known.clear()
        split = [words_of(t) for t in texts]
        met: set[str] = set()
        for words in split:
            met.update(words)
        new = list(met.difference(self.known))
        for at in range(0, len(new), len(SHORT) * _AT_ONCE):
            some = new[at:at + len(SHORT) * _AT_ONCE]
            made = self.vocabulary.encode_words(some)
            self._check_words(some, made)
            self.known.update(zip(some, made, strict=True))
        begin, end = (struct.pack("<I", i) for i in (self.vocabulary.begin, self.vocabulary.end))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join([begin, *map(known, words), end]), "<u4") for words in split]

    def _check_words(self, words: list[str], made: list[bytes]) -> None:
        # the library puts its own space in front; a single space stands for no text of its own
        checked = [(w, ids) for w, ids in zip(words, made, strict=True) if len(w) > 1]
        theirs = self.vocabulary.library.encode(
            [w[1:].replace(SPACE, " ") for w, _ in checked], num_threads=1
        )
        for (w, ids), expected in zip(checked, theirs, strict=True):
            if ids != struct.pack(f"<{len(expected)}I", *expected):
                raise ValueError(f"the library encodes {w!r} differently")

    def check_texts(self, texts: list[str], encoded: list[np.ndarray]) -> None:
        """Whole texts against the library, IDs and decoded text."""
        library = self.vocabulary.library
        theirs = library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
        for text, ids, expected in zip(texts, encoded, theirs, strict=True):
            if ids.tolist() != expected:
                raise ValueError(f"the library encodes {text[:80]!r} differently")
            if self.vocabulary.decode(expected) != library.decode(expected):
                raise ValueError(f"the library decodes {text[:80]!r} differently")


def encode_decode(
    docs: DataFrame, path: str, check_texts: bool = False, id_column: str = "doc_id",
    text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if wanted, ``ids, decoded``.

    Null texts count as empty and give the begin and end IDs.  ``check_texts`` compares every whole
    text with the library as well as every word.  A word longer than memory is not a concern: the
    agenda holds at most one entry per pair and merge.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Batches) -> Iterator[dict]:
        encoder = Encoder(path)
        for batch in batches:
            texts = strings(batch.column("text"))
            encoded = encoder.encode_batch(texts)
            if check_texts:
                encoder.check_texts(texts, encoded)
            decoded = [encoder.vocabulary.decode(ids.tolist()) for ids in encoded]
            out = {
                "doc_id": batch.column("id"),
                "n_tokens": [len(x) for x in encoded],
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in encoded],
                "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in decoded],
            }
            yield out | ({"ids": [x.tolist() for x in encoded], "decoded": decoded} if with_ids else {})

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, schema)

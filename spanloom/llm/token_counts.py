"""Token counts by dynamic programming over a trie of distinct pre-tokens.

A task puts the distinct pre-tokens it meets into one trie.  The best score of spelling a prefix
with vocabulary pieces is a function of the prefix alone, so it is computed once per node: the best
of the node's ancestors plus the piece that leads from there to the node.  Where a pre-token ends
the number of pieces of the best spelling is stored, and later documents look it up.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Batches, map_rows, strings

SPACE = "▁"
#: A piece missing from the vocabulary costs this much more than the worst piece, per character.
UNKNOWN_MARGIN = 10.0
#: Characters at the end of a text that tell how long the pieces ending there can be.
TAIL = 3
#: Trie nodes that a task keeps; beyond that it starts afresh.
NODES = 400_000


class Unigram:
    """Scores of a vocabulary file; characters it lacks count as one token per byte."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores = {
            library.id_to_piece(i): library.get_score(i)
            for i in range(library.vocab_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))
        }
        #: by the last characters of a text, the lengths that a piece ending there can have, rising
        sizes: dict[str, set[int]] = {}
        for piece in self.scores:
            if len(piece) >= TAIL:
                sizes.setdefault(piece[-TAIL:], set()).add(len(piece))
        self.short = tuple(range(1, TAIL))
        self.sizes = {tail: (*self.short, *sorted(found)) for tail, found in sizes.items()}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_MARGIN


class Trie:
    """Nodes in flat lists: children, best score, number of tokens, last characters."""

    def __init__(self, unigram: Unigram):
        self.unigram = unigram
        self.children: list[dict[str, int]] = [{}]
        self.best: list[float] = [0.0]
        self.tokens: list[int] = [0]
        #: number of tokens of the pre-tokens that end somewhere
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Number of tokens of a pre-token; forward scores are computed for new nodes only."""
        scores, sizes, short = self.unigram.scores.get, self.unigram.sizes.get, self.unigram.short
        children, bests, counts = self.children, self.best, self.tokens
        node, path = 0, [0]
        for depth, char in enumerate(word, 1):
            following = children[node].get(char)
            if following is None:
                best = bests[node] + self.unigram.unknown
                tokens = counts[node] + (1 if char < "\x80" else len(char.encode("utf-8", "replace")))
                for size in sizes(word[depth - TAIL if depth > TAIL else 0:depth], short):
                    start = depth - size
                    if start < 0:
                        break
                    piece = scores(word[start:depth])
                    if piece is not None:
                        before = path[start]
                        score = bests[before] + piece
                        count = counts[before] + 1
                        if score > best or score == best and count < tokens:
                            best, tokens = score, count
                following = len(children)
                children[node][char] = following
                children.append({})
                bests.append(best)
                counts.append(tokens)
            node = following
            path.append(node)
        self.terminal[word] = self.tokens[node]
        return self.tokens[node]


def pre_tokens(text: str) -> list[str]:
    """Words with the space in front; line breaks and other white space part words as well."""
    return [SPACE + w for w in text.split()]


def token_counts(
    docs: DataFrame, path: str, nodes: int = NODES, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` per row: words and tokens of their best spellings.

    Null and empty texts have none.  Nothing is shuffled; memory is one trie of ``nodes`` nodes and
    the longest text.
    """

    def run(batches: Batches) -> Iterator[dict]:
        unigram = Unigram(path)
        trie = Trie(unigram)
        for batch in batches:
            words, tokens = [], []
            for text in strings(batch.column("text")):
                split = pre_tokens(text)
                if len(trie.children) > nodes:
                    trie = Trie(unigram)
                # sorted, so that neighbours share their path
                for new in sorted(set(split).difference(trie.terminal)):
                    trie.insert(new)
                words.append(len(split))
                tokens.append(sum(map(trie.terminal.__getitem__, split)))
            yield {"doc_id": batch.column("id"), "n_words": words, "n_tokens": tokens}

    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    return map_rows(rows, run, "doc_id long, n_words long, n_tokens long")

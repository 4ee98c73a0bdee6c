"""Token counts of a unigram model by trie-shared dynamic programming.

The pieces of a public vocabulary get the probabilities of Zipf's law by their rank. A pre-token
is a word with the mark of a word start. The distinct new pre-tokens of a block make a trie whose nodes
hold the best score of the string up to there, and its number of tokens: computed once for all words that share the prefix,
from the pieces that are open at its parent. The trie is walked depth first, so only one path of it is held. The count at a
pre-token's last node is stored, and a document's count is the sum over its words. Nothing is shuffled; a worker keeps the
counts of `MOST_WORDS` pre-tokens and those of a block, and then starts anew, which changes no count.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import blocks

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
MOST_WORDS = 400_000
#: Bytes of text of a block, or a single longer text.
BLOCK_BYTES = 4 << 20
#: Offset of a rank in Zipf's law.
FLATTENING = 2.7


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def load_pieces(path: str) -> dict[str, float]:
    """Log probability of each piece of a vocabulary file, in the order of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = sum(1 / (rank + FLATTENING) for rank in range(len(pieces)))
    return {p: -math.log((rank + FLATTENING) * total) for rank, p in enumerate(pieces)}


class TokenTrie:
    """Trie of pre-tokens with the best segmentation of every prefix.

    Scores add the pieces' log probabilities; of equal scores the one with fewer tokens counts. A
    character that no piece covers costs one token per UTF-8 byte, each as rare as the rarest piece.
    """

    def __init__(self, pieces: dict[str, float]):
        self.rarest = min(pieces.values(), default=0.0)
        #: Trie of the pieces: a node has its children by character, and its piece's log probability by "".
        self.pieces: dict = {}
        for piece, worth in pieces.items():
            node = self.pieces
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = worth
        self.clear()

    def clear(self) -> None:
        self.counts: dict[bytes, int] = {}

    def insert(self, words: set[bytes]) -> None:
        """Store the number of tokens of each word. The trie of the words is walked depth first, in their order."""
        path = [(0.0, 0)]  # score, minus the number of tokens, of every prefix of the word at hand
        going: list[list[tuple[int, dict]]] = [[]]  # pieces that go on after a prefix: where they start, and their node
        root, rarest, before = self.pieces, self.rarest, ""
        for token, word in sorted((WORD_START + w.decode("utf-8", "replace"), w) for w in words):
            shared = 0
            for x, y in zip(before, token, strict=False):
                if x != y:
                    break
                shared += 1
            del path[shared + 1 :], going[shared + 1 :]
            for at in range(shared, len(token)):
                char = token[at]
                n_bytes = len(char.encode())
                score, n = path[at]
                best, still = (score + n_bytes * rarest, n - n_bytes), []
                for start, piece in (*going[at], (at, root)):
                    piece = piece.get(char)
                    if piece is not None:
                        still.append((start, piece))
                        worth = piece.get("")
                        if worth is not None:
                            score, n = path[start]
                            best = max(best, (score + worth, n - 1))
                path.append(best)
                going.append(still)
            self.counts[word] = -path[-1][1]
            before = token

    def count(self, texts: list[list[bytes]]) -> list[int]:
        """Tokens of all words of each text, each with the mark of a word start."""
        new = set().union(*texts).difference(self.counts)
        if new and len(self.counts) > MOST_WORDS:
            self.clear()
            new = set().union(*texts)
        self.insert(new)
        return [sum(map(self.counts.__getitem__, words)) for words in texts]


@cache
def trie_of(path: str) -> TokenTrie:
    """One per worker process, kept from task to task."""
    return TokenTrie(load_pieces(path))


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, locate: Callable[[str], str] = public_path
) -> DataFrame:
    """`(doc_id, n_pretokens, n_tokens)`, one row per row of `docs`.

    Words are runs of characters other than \\x20 and \\x09-\\x0D of the whole text; a null or empty
    text has none, and an empty table gives no row. A very long text is a block of its own. `locate` gives a vocabulary's path where the task runs. Columns other than doc_id and text are
    not read; rows that repeat others are counted like them.
    """

    def count(batches):
        trie = trie_of(locate(vocabulary))
        for batch in batches:
            for ids, texts in blocks(batch.column(0), batch.column(1), BLOCK_BYTES):
                words = [(text or b"").split() for text in texts]
                columns = [pa.array(ids, pa.int64()), pa.array(map(len, words), pa.int64()), pa.array(trie.count(words), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")

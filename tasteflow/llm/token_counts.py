"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word with the space before it written as a marker.  Its best
segmentation under a unigram vocabulary is found by forward scores: the best
score of a prefix is the best over its last piece; an automaton over the pieces
names those that end there.  A prefix is a trie node, so
words sharing a prefix share its scores; the node where a word ends stores the
count of pieces on its best path.

The vocabulary is a public one.  Its pieces are listed by merge rank; a piece of
rank r gets probability proportional to 1 / (r + 1) (Zipf's law), so nothing is
trained.  A character outside the vocabulary costs its UTF-8 bytes, one token
each.  Equal scores: the segmentation with fewer pieces counts.

One pass over the documents without a shuffle.  A task's nodes are dropped when they
pass ``max_nodes``, the counts of the words seen when these do, and a word of over ``LONG_WORD`` characters is scored by the
same recurrence over a window as long as the longest piece, without nodes; that
bounds memory and changes no count.

Defined results: null and empty texts have no tokens; repeated documents are
counted independently.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls

MARK = "▁"
BYTE_LOG_PROB = -30.0  # of one fallback byte: dearer than any piece, so used only where no piece fits

LONG_WORD = 256  # characters of the longest word that the trie keeps


@lru_cache(maxsize=1)
def _vocabulary(model_path: str) -> tuple[dict[str, float], PieceEnds]:
    """Pieces and their automaton, kept by the worker for its next task."""
    pieces = zipf_pieces(model_path)
    return pieces, PieceEnds(pieces)


def zipf_pieces(model_path: str) -> dict[str, float]:
    """Log-probability of each ordinary piece of a public vocabulary, by its rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ranked = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    total = math.log(sum(1.0 / (r + 1) for r in range(len(ranked))))
    return {piece: -math.log(r + 1) - total for r, piece in enumerate(ranked)}


class PieceEnds:
    """Automaton that tells which pieces end at each letter of a word (Aho-Corasick).

    ``step`` leads from a state, the longest beginning of a piece that ends here, by a letter; ``shorter`` to the next
    shorter such beginning; ``found`` lists a state's pieces as (letters, log-probability).
    """

    def __init__(self, pieces: dict[str, float]) -> None:
        self.step: dict[tuple[int, str], int] = {}
        self.shorter, self.found = [0], [()]
        state_of = {"": 0}
        for start in sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)}, key=len):
            state, letter = len(self.found), start[-1]
            state_of[start] = state
            before = state_of[start[:-1]]
            self.shorter.append(self.after(self.shorter[before], letter) if before else 0)
            self.step[before, letter] = state
            own = ((len(start), pieces[start]),) if start in pieces else ()
            self.found.append(own + self.found[self.shorter[state]])

    def after(self, state: int, letter: str) -> int:
        """The state after one more letter."""
        while (there := self.step.get((state, letter))) is None:
            if not state:
                return 0
            state = self.shorter[state]
        return there


class _Terminals(dict):
    """Piece count of each word seen, as UTF-8; another word is scored when it is asked for."""

    def __init__(self, score) -> None:
        self.score_word = score

    def __missing__(self, raw: bytes) -> int:
        return self.score_word(raw)


class PrefixTrie:
    """Trie of pre-tokens whose nodes hold the forward score and piece count of their prefix."""

    def __init__(self, pieces: dict[str, float], max_nodes: int = 400_000, ends: PieceEnds | None = None) -> None:
        self.pieces, self.max_nodes = pieces, max_nodes
        self.longest = max(map(len, pieces), default=1)
        self.ends = ends or PieceEnds(pieces)
        self.terminal = _Terminals(self._scored)
        self.reset()

    def reset(self) -> None:
        self.child: dict[int, int] = {}  # by node and letter
        self.score, self.count, self.state = [0.0], [0], [0]

    def _rolled(self, word: str) -> int:
        """Pieces of the best segmentation, from the scores of the last ``longest`` prefixes only."""
        last = deque([(0.0, 0)], maxlen=self.longest)  # score and -count, nearest prefix first
        for end, letter in enumerate(word, 1):
            fallback = len(letter.encode("utf-8", "surrogatepass"))
            best = (last[0][0] + BYTE_LOG_PROB * fallback, last[0][1] - fallback)
            for back, (score, count) in enumerate(last, 1):
                log_prob = self.pieces.get(word[end - back:end])
                if log_prob is not None:
                    best = max(best, (score + log_prob, count - 1))
            last.appendleft(best)
        return -last[0][1]

    def tokens(self, raw: bytes) -> int:
        """Pieces of the best segmentation of a word, given as UTF-8 without its marker."""
        return self.terminal[raw]

    def total(self, words: list[bytes]) -> int:
        """Pieces of all the words."""
        return sum(map(self.terminal.__getitem__, words))

    def _scored(self, raw: bytes) -> int:
        if len(self.score) > self.max_nodes:
            self.reset()
        if len(self.terminal) > self.max_nodes:
            self.terminal.clear()
        word, path = MARK + raw.decode("utf-8", "replace"), [0]
        if len(word) > LONG_WORD:
            return self._rolled(word)
        child, scores, counts, states, node = self.child, self.score, self.count, self.state, 0
        after, found = self.ends.after, self.ends.found
        for end, letter in enumerate(word, 1):
            edge = node << 21 | ord(letter)
            known = child.get(edge)
            if known is None:  # a new node, scored from the nodes of its shorter prefixes
                fallback = 1 if letter < "\x80" else len(letter.encode("utf-8", "surrogatepass"))
                best, fewest = scores[node] + BYTE_LOG_PROB * fallback, counts[node] + fallback
                state = after(states[node], letter)
                for size, log_prob in found[state]:
                    start = path[end - size]
                    score = scores[start] + log_prob
                    if score > best or score == best and counts[start] + 1 < fewest:
                        best, fewest = score, counts[start] + 1
                known = child[edge] = len(scores)
                scores.append(best)
                counts.append(fewest)
                states.append(state)
            node = known
            path.append(node)
        self.terminal[raw] = counts[node]
        return counts[node]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_pretokens``, ``n_tokens`` and ``n_bytes``, over whole texts."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, ends = _vocabulary(model_path)
        trie = PrefixTrie(pieces, ends=ends)
        for batch in calls(batches, "text"):
            words_, tokens, sizes = [], [], []
            for text in batch.column(1).to_pylist():
                words = text.split()
                total = trie.total(words)
                words_.append(len(words))
                tokens.append(total)
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words_, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(sizes, pa.int64())], names=[id_col, "n_pretokens", "n_tokens", "n_bytes"])

    rows = docs.select(F.col(id_col), blob(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(kernel, f"`{id_col}` {id_type}, n_pretokens bigint, n_tokens bigint, n_bytes bigint")

"""Unigram token counts without token lists.

An Aho-Corasick automaton over the vocabulary meets every piece that ends at
each character.  Dynamic programming carries, for each end, the best score
and the number of tokens on the best way there; no back pointers are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Mark before each word.
WORD_MARK = "▁"
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker remembers, in each of two generations.
REMEMBERED = 300_000


class Memory(dict):
    """Remembers what ``make`` gives for a key, in two bounded generations:
    when the young one is full it becomes the old one.  Forgetting costs time
    only."""

    def __init__(self, most: int, make: Callable):
        super().__init__()
        self.most, self.make, self.old = most, make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class UnigramCounter:
    """Counts the tokens of a word under a unigram vocabulary.

    Ties go to the piece met first for an end, that is the longest one, as a
    lattice does that replaces only on a strictly better score.  A character
    that no piece of its own covers is unknown: its score is the worst score
    less 10, and it counts one token for each UTF-8 byte (byte fallback) or,
    without byte pieces, one token for a whole run of unknown characters."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and piece not in self.machine:
                self.machine.add_word(piece, (len(piece), score))
        if pieces:
            self.machine.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback

    def count(self, word: str) -> int:
        n = len(word)
        score, tokens = [0.0] * (n + 1), [0] * (n + 1)
        run = [False] * (n + 1)  # the best way here ends in an unknown character
        met = 0  # characters whose ends are settled
        best, ways, single = None, 0, True
        for end, (length, value) in self.machine.iter(word) if len(self.machine) else ():
            while met <= end:  # settle the ends before this one
                if best is not None and single:
                    score[met], tokens[met] = best, ways
                elif met:
                    self._unknown(word, met, best, ways, score, tokens, run)
                met += 1
                best, ways, single = None, 0, False
            start = end + 1 - length
            total = score[start] + value
            if best is None or total > best:
                best, ways = total, tokens[start] + 1
            if length == 1:
                single = True
        while met <= n and n:
            if best is not None and single:
                score[met], tokens[met] = best, ways
            elif met:
                self._unknown(word, met, best, ways, score, tokens, run)
            met += 1
            best, ways, single = None, 0, False
        return tokens[n]

    def _unknown(self, word, end, best, ways, score, tokens, run) -> None:
        """Settle an end whose last character no piece of its own covers: the
        unknown character competes after all pieces that were met."""
        value = score[end - 1] + self.unknown
        if best is None or value > best:
            best, run[end] = value, True
            if self.byte_fallback:
                ways = tokens[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            else:
                ways = tokens[end - 1] + (0 if run[end - 1] else 1)
        score[end], tokens[end] = best, ways


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece vocabulary file, without control,
    unknown, unused and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)):
            out.append((model.id_to_piece(i), model.get_score(i)))
    return out


_loaded: dict[str, Memory] = {}


def word_memory(counter: UnigramCounter, most: int = REMEMBERED) -> Memory:
    """Token counts of words: each is counted with the mark before it."""
    return Memory(most, lambda word: counter.count(WORD_MARK + word))


def text_tokens(text: str | None, memory: Memory) -> tuple[int, int]:
    """(words, tokens) of a text; words are split at white space."""
    split = (text or "").split()
    return len(split), sum(map(memory.__getitem__, split))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``n_tokens`` for each row of ``docs``.

    The vocabulary file's place is ``path``, the same on every executor.
    Null, empty and blank texts have 0 tokens.  Repeated rows are counted one
    by one; other columns are not read.  Memory is bounded by an Arrow batch,
    the longest word and the remembered words.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = word_memory(UnigramCounter(load_pieces(path)))
        memory = _loaded[path]
        for b in batches:
            pairs = [text_tokens(t.as_py(), memory) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([w for w, _ in pairs], pa.int64()), pa.array([n for _, n in pairs], pa.int64())],
                ["doc_id", "n_words", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(f"`{id_col}`", f"`{text}`").mapInArrow(run, f"doc_id {kind}, n_words bigint, n_tokens bigint")

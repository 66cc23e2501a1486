"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
place of a word; dynamic programming keeps, per place, only the best score
and the number of pieces on the best path.  Tie rules are those of the
unigram tokenizer: a path replaces another only if its score is strictly
greater, starts being tried from the left, so of equal paths the one with the
longest last piece stays.  A character without a piece of its own costs the
least score minus ``UNK_PENALTY`` and counts as its UTF-8 bytes (byte
fallback), or, without byte pieces, once per run of such characters.

Blanks become U+2581 and one is put in front.  A text is cut before a U+2581
only where no piece of the vocabulary can reach over the cut (none has the
character before it followed by U+2581): with pieces of several blanks, a run of
blanks stays together with the word after it.  So a text is the sum of its
words and a word is counted once per task (a cache of ``CACHE`` words, emptied
when full).  Characters that stand in no longer piece divide words further.

The vocabulary (bounded: the tokenizer's own file) is read on the driver and
broadcast as a list of pieces and scores.  Nulls and empty texts have 0
tokens.  Texts are counted whole.  Repeated rows each get their count; empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNK_PENALTY = 10.0
CACHE = 250_000
_NEVER = float("-inf")
_BLANKS_AND_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], bool]:
    """Ordinary pieces with their scores, and whether the file has byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(n)
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    return pieces, any(sp.is_byte(i) for i in range(n))


class WordCounts(dict):
    """word -> number of tokens, filled on demand."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNK_PENALTY
        self.byte_pieces = byte_pieces
        # characters after which a piece can go on with a blank
        self.before = {a for p, _ in pieces for a, b in zip(p, p[1:]) if b == SPACE}
        if byte_pieces or SPACE in self.single:
            kept = "".join(re.escape(c) for c in sorted(self.before))
            self.cut = re.compile("(?s)(?<=.)" + (f"(?<![{kept}])" if kept else "") + f"(?={SPACE})")
        else:
            self.cut = None  # a run of unknown characters goes on over blanks
        self.divides = "" if any("\n" in p for p, _ in pieces if len(p) > 1) or not byte_pieces else "\n"

    def __missing__(self, word: str) -> int:
        n = len(word)
        score, count = [0.0] + [_NEVER] * n, [0] * (n + 1)
        if self.single.issuperset(word):
            # matches come by their end, longest first: the earliest start keeps a tie
            for end, (length, s) in self.automaton.iter(word):
                start = end + 1 - length
                candidate = score[start] + s
                if candidate > score[end + 1]:
                    score[end + 1], count[end + 1] = candidate, count[start] + 1
        else:
            self._with_unknown(word, score, count)
        if len(self) >= CACHE:
            self.clear()
        if n <= 64:  # long words are rare and would fill the cache with bytes
            self[word] = count[n]
        return count[n]

    def _with_unknown(self, word: str, score: list, count: list) -> None:
        """The same, with unknown characters tried after the matches that end at them."""
        in_unknown, done = [False] * (len(word) + 1), 0

        def finish(upto: int) -> int:
            for end in range(done + 1, upto + 1):
                c = word[end - 1]
                if c not in self.single and score[end - 1] + self.unknown > score[end]:
                    more = len(c.encode()) if self.byte_pieces else int(not in_unknown[end - 1])
                    score[end], count[end] = score[end - 1] + self.unknown, count[end - 1] + more
                    in_unknown[end] = True
            return upto

        for end, (length, s) in self.automaton.iter(word):
            done = finish(end)
            start = end + 1 - length
            candidate = score[start] + s
            if candidate > score[end + 1]:
                score[end + 1], count[end + 1] = candidate, count[start] + 1
        finish(len(word))

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        if marked[0] != SPACE:
            marked = SPACE + marked
        if self.divides and self.divides in marked:
            parts = marked.split(self.divides)
            return (len(parts) - 1) * self["\n"] + sum([self._of_part(p) for p in parts if p])
        return self._of_part(marked)

    def _of_part(self, part: str) -> int:
        if self.cut is None:
            return self[part]
        if self.before - {SPACE}:
            return sum([self[w] for w in self.cut.split(part)])
        if SPACE in self.before and SPACE * 2 in part:
            return sum([self[w] for w in _BLANKS_AND_WORD.findall(part)])
        words = part.split(SPACE)
        return (self[words[0]] if words[0] else 0) + sum([self[SPACE + w] for w in words[1:]])


def token_counts(docs: DataFrame, vocabulary: tuple[list[tuple[str, float]], bool] | None = None) -> DataFrame:
    """(doc_id, n_tokens) per row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())

    def count(batches):
        counts = WordCounts(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([counts.of_text(t.as_py()) for t in batch.column(1)], pa.int64())],
                names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "doc_id long, n_tokens long")

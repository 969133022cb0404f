"""Token counts of a unigram tokenizer without making tokens: Viterbi for the count alone.

White space ends a word, and a word begins with U+2581. An Aho-Corasick automaton over
the vocabulary gives all pieces that end at each character, longest first; dynamic
programming keeps the best score and the number of pieces of the best way there. The
rules are those of the public unigram implementation: a later way must be strictly
better, so of equal ones the longest last piece wins; a character that is no piece
costs ten below the least score; neighbouring unknown characters are one unknown
token, or one token a byte where the vocabulary has bytes. Control, unknown and byte
pieces are never read out of a text.

The pieces come from a vocabulary file whose path is a parameter; it is read on the
driver and shipped (a vocabulary is of fixed size). Counts of words are kept in each
worker in a table of bounded size, as the same words come again and again. A word of any
length takes memory for the longest piece alone.

Defined cases: NULL and empty texts and those of white space have 0 tokens; a text of
any length is counted whole; repeated rows are rows; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker keeps, and the longest such word.
CACHE_WORDS, CACHE_LENGTH = 500_000, 48
_NO_MORE = (-1, (0, 0.0))
#: Characters with the Unicode property White_Space.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Text pieces with their scores, and whether all 256 bytes are pieces too."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_unused(i)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in ids if not special(i) and not model.is_byte(i)]
    return pieces, sum(model.is_byte(i) for i in ids) == 256


class Counter:
    def __init__(self, pieces: Sequence[tuple[str, float]], has_bytes: bool):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.longest = max((len(piece) for piece, _ in pieces), default=1)
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.has_bytes = has_bytes
        self.kept: dict[str, int] = {}

    def count(self, text: str) -> int:
        """Tokens of one marked word."""
        # Only as many earlier places are kept as the longest piece reaches back.
        span = self.longest + 1
        scores, counts = [0.0] * span, [0] * span
        loose = [False] * span  # the way ends in an unknown character
        found = self.automaton.iter(text) if len(self.automaton) else iter(())
        end, piece = next(found, _NO_MORE)
        for at, char in enumerate(text):
            best, number, unknown, single = None, 0, False, False
            while end == at:
                length, score = piece
                start = (at + 1 - length) % span
                total = score + scores[start]
                if best is None or total > best:
                    best, number = total, counts[start] + 1
                single = single or length == 1
                end, piece = next(found, _NO_MORE)
            here, there = at % span, (at + 1) % span
            if not single:
                total = self.unknown + scores[here]
                if best is None or total > best:
                    more = len(char.encode("utf-8", "surrogatepass")) if self.has_bytes else not loose[here]
                    best, number, unknown = total, counts[here] + more, True
            scores[there], counts[there], loose[there] = best, number, unknown
        return counts[len(text) % span]

    def total(self, text: str | None) -> int:
        kept, out = self.kept, 0
        for word in SPACE.split(text or ""):
            if word:
                number = kept.get(word)
                if number is None:
                    number = self.count(MARK + word)
                    if len(word) <= CACHE_LENGTH:
                        if len(kept) >= CACHE_WORDS:
                            kept.clear()
                        kept[word] = number
                out += number
        return out


def count_tokens(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the number of tokens of its whole text."""
    shipped = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    counter: list[Counter] = []

    def tokens(text: pd.Series) -> pd.Series:
        if not counter:
            counter.append(Counter(*shipped.value))
        return pd.Series([counter[0].total(t) for t in text], dtype="int64")

    return documents.select("doc_id", F.pandas_udf(tokens, LongType())(F.col("text")).alias("n_tokens"))

"""Token ids of whole texts, with the encodings of repeated stretches remembered."""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import chain

import numpy as np

# Characters with the Unicode property White_Space.
SPACES = "\t-\r \x85\xa0  -     　"
# Stretches that a byte-level pre-tokenizer never joins with what stands around them: a whole run
# of letters, or what follows it up to white space, with one blank before it; or white space.
UNITS = re.compile(
    f" ?[A-Za-zÀ-ÖØ-öø-ÿ]++(?![^\\W\\d_])| ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
MEMO_UNITS = 600_000
MEMO_LENGTH = 48
END_ID = 0
# A blank in the tokens of a byte-level tokenizer.
BLANK = "\u0120"
# Characters that are encoded in one call: words with a blank before them, one after the other.
JOINED_CHARS = 20_000


class Encoder:
    """Texts to ids by a ``tokenizers`` file, as the untouched tokenizer encodes them.

    Strings of special tokens inside a text become their own ids, and what stands between them is
    encoded apart.  Encoding such a stretch equals encoding its UNITS one by one, because the
    byte-level pre-tokenizer cuts there anyway; most units repeat, so their ids are looked up.
    """

    def __init__(self, path: str):
        # Tasks already use every core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.memo: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values(), default=0) + 1
        # Ids whose token begins with a blank.
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True

    def _units(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not any(token in text for token in self.added):
            return UNITS.findall(text)
        parts = self.cut.split(text)
        return [u for i, part in enumerate(parts) for u in ([part] if i % 2 else UNITS.findall(part))]

    def _encoded(self, units: list[str]):
        found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return ((u, array("I", e.ids).tobytes()) for u, e in zip(units, found, strict=True))

    def _encoded_words(self, words: list[str]):
        """Pairs of a word and its ids.  A byte-level pre-tokenizer cuts before the blank of each word, so
        words are encoded many at once, and a word's ids begin where a token begins with a blank."""
        ends = np.cumsum([len(w) for w in words]) // JOINED_CHARS
        cuts = (np.flatnonzero(np.diff(ends)) + 1).tolist()
        for first, last in zip([0, *cuts], [*cuts, len(words)], strict=True) if words else []:
            some = words[first:last]
            joined = "".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(self.opens[ids]).tolist()
            if len(starts) != len(some) or any(token in joined for token in self.added):
                yield from self._encoded(some)
                continue
            data = ids.tobytes()
            yield from ((w, data[4 * a:4 * b]) for w, a, b in zip(some, starts, [*starts[1:], len(ids)], strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and END_ID, as little-endian unsigned 32-bit numbers; null is empty.

        A full memory takes no more units; those are then encoded anew in every group.
        """
        units, memo = list(map(self._units, texts)), self.memo
        unknown = list(set(chain.from_iterable(units)).difference(memo))
        full = len(memo) >= MEMO_UNITS
        words = [u for u in unknown if u[0] == " " and u[1:].isalpha()]
        others = set(unknown).difference(words)
        memo.update(self._encoded_words(words))
        memo.update(self._encoded(list(others)))
        end = END_ID.to_bytes(4, "little")
        out = [b"".join(map(memo.__getitem__, u)) + end for u in units]
        for unit in unknown:
            if full or len(unit) > MEMO_LENGTH:
                del memo[unit]
        return out


@cache
def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker; what it remembers serves the tasks that follow."""
    return Encoder(path)


def encoded_batches(texts: list[str | None], encoder: Encoder, chars: int = 1_000_000):
    """Yield the ids of each text in turn; texts are encoded in groups of bounded size."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= chars:
            yield from encoder.encode(group)
            group, size = [], 0
    yield from encoder.encode(group)

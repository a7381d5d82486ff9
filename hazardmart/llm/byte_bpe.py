"""Byte-level BPE vocabulary read from a tokenizer file: splitting into pieces and merging bytes."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
from tokenizers import Tokenizer

# The pre-tokenizer's pattern in the notation of ``re``, and its long contractions.
PIECES = re.compile(
    r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]++| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+"
)
CONTRACTIONS = ("'re", "'ve", "'ll")

# Inside these ranges ``re`` and the tokenizer's library agree what is a letter, number or space
# (a test compares every code point); texts with other characters are split by the library.
FOREIGN = re.compile(
    "[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u0557\u2010-\u205e\u20a0-\u20bf\u4e00-\u9fef\uac00-\ud7a3]"
)

# Remembered answers to "may this token follow that one" per process.
MOST_PAIRS = 500_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Vocabulary, merges and special strings of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"], spec["model"]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if spec["normalizer"] or not plain or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.path = path
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[char] for char in token)
        self.ids = {as_bytes(token): number for token, number in model["vocab"].items()}
        self.special = {added["content"]: added["id"] for added in spec["added_tokens"]}
        self.token = {number: token for token, number in self.ids.items()}
        self.token |= {number: content.encode() for content, number in self.special.items()}
        self.byte_id = [self.ids[bytes([byte])] for byte in range(256)]
        self.tokens_inside = ahocorasick.Automaton()
        for token, number in self.ids.items():
            self.tokens_inside.add_word(token.decode("latin-1"), (len(token), number))
        self.tokens_inside.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = map(as_bytes, merge.split(" ") if isinstance(merge, str) else merge)
            self.ranks[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        made = {merged: (rank, pair) for pair, (rank, merged) in self.ranks.items()}
        #: Tokens that one merge makes, as all do in a trained vocabulary.
        self.made = made if len(made) == len(self.ranks) else None
        contents = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_strings = re.compile("|".join(contents) or "(?!)")

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def pieces(self, segment: str) -> list[str]:
        """Pieces that no token crosses, in order; together they are the segment."""
        if FOREIGN.search(segment):
            spans = self.library.pre_tokenizer.pre_tokenize_str(segment)
            return [segment[start:end] for _, (start, end) in spans]
        return PIECES.findall(segment)

    def segments(self, text: str) -> Iterator[tuple[str, str | None]]:
        """Ordinary text and the special string that ends it; the last has none."""
        start = 0
        for match in self.special_strings.finditer(text):
            yield text[start : match.start()], match.group()
            start = match.end()
        yield text[start:], None

    def merge(self, data: bytes) -> list[int]:
        """Ids of a few bytes by the merges themselves: lowest rank first, leftmost among equals."""
        ids, none = [self.byte_id[byte] for byte in data], (len(self.ranks), -1)
        while len(ids) > 1:
            found = [self.ranks.get(pair, none) for pair in zip(ids, ids[1:], strict=False)]
            best = min(found)
            if best is none:
                break
            at = found.index(best)
            ids[at : at + 2] = [best[1]]
        return ids

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one end of ``token`` while it is built, and the rank that ends each."""
        edge, until = [], float("inf")
        while True:
            edge.append((token, until))
            if token not in self.made:
                return edge
            until, pair = self.made[token]
            token = pair[side]

    def _follows(self, left: int, right: int) -> bool:
        """Whether two tokens side by side (or one, after -1) are what their bytes encode to."""
        if left < 0 or self.made is None:
            pair = [token for token in (left, right) if token >= 0]
            return self.merge(b"".join(map(self.token.__getitem__, pair))) == pair
        # No merge across the seam may come before both of its sides are merged elsewhere.
        for one, one_until in self._edge(left, 1):
            for other, other_until in self._edge(right, 0):
                found = self.ranks.get((one, other))
                if found and found[0] < one_until and found[0] <= other_until:
                    return False
        return True

    def prefix_ends(self, data: bytes) -> tuple[list[int], list[int]]:
        """Last token and token count of every prefix of one piece, the empty one first.

        Of the tokens that end a prefix exactly one may follow the encoding of what precedes it.
        """
        pairs = self.pairs
        last, counts = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        for end, (length, token) in self.tokens_inside.iter(data.decode("latin-1")):
            end += 1
            if counts[end]:
                continue
            before = last[end - length]
            follows = pairs.get(before << 32 | token)
            if follows is None:
                if len(pairs) >= MOST_PAIRS:
                    pairs.clear()
                follows = pairs[before << 32 | token] = self._follows(before, token)
            if follows:
                last[end], counts[end] = token, counts[end - length] + 1
        return last, counts


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """One vocabulary per worker process."""
    return ByteBpe(path)

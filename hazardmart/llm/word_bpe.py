"""Ids of texts under a BPE vocabulary of lower-cased words, each word encoded once while remembered."""

from __future__ import annotations

import json
import re
from functools import cache, cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from hazardmart.llm.byte_bpe import byte_alphabet

# The pattern by which the word vocabulary's file splits texts, and its mark of word ends.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# The same split for lower-cased words of plain characters, which normalisation leaves as they are.
ODD = "[^!-~À-ÖØ-öø-ÿ]"
PIECES = re.compile("'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")

# These separate words for ``str.split`` but not for the tokenizer.
UNLIKE = "\x1c\x1d\x1e\x1f"
BLANKS = re.compile(r"[ \t\n\r\f\v]+")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PieceRanks:
    """The vocabulary as merge ranks for the faster library: a piece's last byte merges with a zero byte first.

    That library merges two neighbours whenever a token spells them together, whichever pair the
    file makes the token of. Both agree if merging the symbols of each token alone gives the token: as
    long as no merge crosses a token's borders, what happens inside does not depend on what is outside.
    """

    def __init__(self, model: dict):
        as_byte = byte_alphabet()

        def spelled(token: str) -> bytes:
            ended = token.endswith(WORD_END)
            return bytes(as_byte[char] for char in (token.removesuffix(WORD_END))) + b"\0" * ended

        merges = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in model["merges"]]
        order = {pair: rank for rank, pair in enumerate(merges)}
        ranks = {bytes([byte, 0]): byte for byte in range(256)}
        ids = np.zeros(512 + len(merges), np.uint32)
        for char, byte in as_byte.items():
            ids[byte], ids[256 + len(merges) + byte] = model["vocab"][char + WORD_END], model["vocab"][char]
            ranks[bytes([byte])] = 256 + len(merges) + byte
        for rank, (left, right) in enumerate(merges):
            ranks[spelled(left) + spelled(right)] = 256 + rank
            ids[256 + rank] = model["vocab"][left + right]
        self.made, self.order = len(ranks) == len(ids), order
        self.ids = ids
        pattern = r"[^\x00\n]+\x00|\n"
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.newline = 256 + len(merges) + ord("\n")

    def exact(self) -> bool:
        """Whether the two libraries agree on every text."""
        return self.made and all(_merged(left + right, self.order) == [left + right] for left, right in self.order)

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each plain word."""
        marked = PIECES.sub("\\g<0>\0", "\n".join(words).lower())
        found = np.array(self.encoding.encode_ordinary(marked), np.uint32)
        ends = np.flatnonzero(found == self.newline)
        whole = self.ids[found].astype("<u4").tobytes()
        starts = [0, *(4 * ends + 4).tolist()]
        return [whole[start:end] for start, end in zip(starts, [*(4 * ends).tolist(), len(whole)], strict=True)]


def _merged(token: str, order: dict[tuple[str, str], int]) -> list[str]:
    """The symbols of a token after all merges, the lowest rank first."""
    ended = token.endswith(WORD_END)
    symbols = list(token.removesuffix(WORD_END))
    if ended:
        symbols[-1] += WORD_END
    while len(symbols) > 1:
        rank, at = min((order.get(pair, len(order)), at) for at, pair in enumerate(zip(symbols, symbols[1:])))
        if rank == len(order):
            break
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


def _by_words(spec: dict) -> bool:
    """Whether the tokenizer lower-cases, drops white space, splits words as ``PIECES`` does and marks their ends."""
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} in normal
    split = before[0].get("pattern") == {"Regex": SPLIT} and before[0].get("behavior") == "Removed" and before[0]["invert"]
    model = spec["model"]
    marked = model["type"] == "BPE" and model.get("end_of_word_suffix") == WORD_END and not model.get("ignore_merges")
    alone = all(not t["lstrip"] and not t["rstrip"] and t["content"].split() == [t["content"]] for t in spec["added_tokens"])
    return bool(blanks and {"type": "Lowercase"} in normal and split and marked and alone)


class WordBpe:
    """A tokenizers file: the library, and the ranks of its words' pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        self.spec["truncation"] = self.spec["padding"] = None
        special = [re.escape(added["content"]) for added in self.spec["added_tokens"]]
        self.odd = re.compile("|".join([ODD, *special])).search

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(json.dumps(self.spec))

    @cached_property
    def ranks(self) -> PieceRanks:
        return PieceRanks(self.spec["model"])

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@cache
def has_ranks(path: str) -> bool:
    """Whether the file's words can be encoded by ranks; checked over the whole vocabulary."""
    return _by_words(word_bpe(path).spec) and word_bpe(path).ranks.exact()


class TextEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers, equal to the library's.

    ``by_ranks`` is what :func:`has_ranks` says. Such a tokenizer drops white space, and no token or
    normalisation crosses it, so a text's ids are those of its words one after another. Words of plain
    characters are encoded by ranks, all new ones of some texts at once. Other words, words with a
    special string (treated as the library does by default) and, with another kind of tokenizer, whole
    texts go to the library as they stand. Beyond ``remembered`` words only the latest texts' are kept.
    """

    def __init__(self, path: str, by_ranks: bool, remembered: int):
        self.bpe, self.by_ranks, self.remembered = word_bpe(path), by_ranks, remembered
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_ranks:
            return [self.bpe.ids(text) for text in texts]
        split = [BLANKS.split(text) if any(char in text for char in UNLIKE) else text.split() for text in texts]
        words = set().union(*split)
        fresh = words - self.known.keys()
        odd = set(filter(self.bpe.odd, fresh))
        self.known.update((word, self.bpe.ids(word)) for word in odd)
        plain = list(fresh - odd)
        if plain:
            self.known.update(zip(plain, self.bpe.ranks.encode(plain), strict=True))
        found = [b"".join(map(self.known.__getitem__, words)) for words in split]
        if len(self.known) > self.remembered:
            self.known = {word: self.known[word] for word in words}
        return found

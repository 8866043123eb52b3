"""Token ids of the public tokenizers, with the bytes that each id stands for."""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

# The pattern by which byte-level tokenizers cut a text before they merge.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The faster library's pattern engine gives up on longer runs of white space.
BLANKS = re.compile(r"\s{512}")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> dict[str, int]:
    """Byte of each character that a byte-level vocabulary writes it as."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Ids of a byte-level tokenizer file.

    Merging runs in tiktoken, on ranks read from the same file, which gives the same ids about
    three times as fast. Files of another make, and texts with very long runs of white space,
    go through the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers.pre_tokenizers import ByteLevel as Cut

        self.path = path
        tokenizer = self._load()
        self.added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        letters = byte_letters()
        self.bytes = [b""] * (max([*vocab.values(), *self.added]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for i, token in self.added.items():
            self.bytes[i] = token.encode()
        before = tokenizer.pre_tokenizer
        self.cuttable = isinstance(before, Cut) and before.use_regex and not before.add_prefix_space and tokenizer.normalizer is None
        self.fast = self._ranked(path, vocab) if self.cuttable else None

    def _load(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def tokenizer(self):
        """The library's own, held only once it is needed."""
        return self._load()

    @cached_property
    def literal(self):
        out = self._load()
        out.encode_special_tokens = True
        return out

    def _ranked(self, path: str, vocab: dict[str, int]):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"].get("merges", [])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        first = len(vocab) - len(pairs)
        # Ids serve as ranks only where they rise in the order of the merges.
        if any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
            return None
        ranks = {self.bytes[i]: i for i in vocab.values()}
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> list[int]:
        """Ids with special tokens' strings as ordinary text."""
        if self.fast is None or BLANKS.search(text):
            return self.literal.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def ids(self, text: str) -> list[int]:
        """Ids with special tokens' strings as special tokens, none added."""
        if any(mark in text for mark in self.added.values()):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.plain(text)


class Pieces:
    """Ids of a sentencepiece model; `cuttable` if no piece goes on past a word's end."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        number = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes = [
            bytes([int(m[1], 16)]) if (m := number.fullmatch(n)) else n.replace("▁", " ").encode("utf-8") for n in names
        ]
        self.cuttable = not any("▁" in n.lstrip("▁") for n in names)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)

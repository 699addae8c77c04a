"""Token counts and ids of a byte-pair tokenizer, word by word, with a memory of the words seen.

Both encoders give what the tokenizers library gives for the whole text; that is tested. They differ
from calling it on each text only in that a word which occurs again is not merged again.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# The split patterns of the two public tokenizers.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Up to this code point the letter and digit classes agree in all regular-expression engines.
PLAIN = regex.compile(r"[^\x00-ɏ]")
# tiktoken's matcher gives up on runs of about a million white-space characters.
LONG_BLANK = regex.compile(r"(?<!\s)\s{100000}")


def open_tokenizer(path: str) -> Tokenizer:
    """The library's own tokenizer, without truncation and padding and on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE file as bytes -> id; a word end is written as byte 255.

    Ids must follow the order of the merges, which is then also tiktoken's order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix, vocabulary = model.get("end_of_word_suffix") or "", model["vocab"]
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocabulary[m] for m in merges]
    if ids != sorted(ids):
        raise ValueError(f"{path}: ids do not follow the merges")

    def raw(token: str) -> bytes:
        end = bool(suffix) and token.endswith(suffix)
        return bytes(byte_of[c] for c in (token[: -len(suffix)] if end else token)) + b"\xff" * end

    return {raw(token): i for token, i in vocabulary.items()}


class TokenCounter:
    """Number of tokens of a text in a byte-level BPE without normalizer (`byte_bpe_50k.json`).

    The merges run in tiktoken, whose ranks are the file's own; texts with characters beyond Latin
    script or very long white space go to the tokenizers library itself. Special strings inside a text count as one token.
    """

    def __init__(self, path: str):
        self.tokenizer = open_tokenizer(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.fast = tiktoken.Encoding(
            "counts", pat_str=BYTE_LEVEL, mergeable_ranks=byte_ranks(path), special_tokens=self.special
        )

    def count(self, text: str) -> int:
        if PLAIN.search(text) or LONG_BLANK.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return len(self.fast.encode(text, allowed_special=set(self.special), disallowed_special=()))


class WordEncoder:
    """Ids of a BPE with word ends that drops white space and case (`word_bpe_49k.json`).

    White space is always between words there, so a text is cut at ASCII white space and each
    distinct word is encoded once: in tiktoken, with an end mark as last byte, when it is Latin script
    without special strings, else by the tokenizers library. The memory is emptied at `limit` words.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.tokenizer = open_tokenizer(path)
        self.merge = tiktoken.Encoding(
            "words", pat_str=WORD_LEVEL, mergeable_ranks=byte_ranks(path), special_tokens={}
        )._core_bpe.encode_single_piece
        self.split = regex.compile(WORD_LEVEL)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ends, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    def encode_word(self, word: str) -> list[int]:
        if not word.isascii() and PLAIN.search(word) or any(s in word for s in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        word = word.lower()
        if word.isalpha():
            return self.merge(word.encode() + b"\xff")
        return [i for p in self.split.findall(word) for i in self.merge(p.encode() + b"\xff")]

    def learn(self, words: set[bytes]) -> None:
        for word in words:
            ids, at = self.encode_word(word.decode()), len(self.known)
            if at + 1 >= len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros(len(self.ends), np.int64)])
            first = int(self.ends[at])
            while first + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
            self.ids[first : first + len(ids)] = ids
            self.ends[at + 1] = first + len(ids)
            self.known[word] = at

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as the library gives them without special tokens around it."""
        words = text.encode().split()
        if len(self.known) > self.limit:
            self.forget()
        found = list(map(self.known.get, words))
        if None in found:
            self.learn({w for w, i in zip(words, found, strict=True) if i is None})
            found = list(map(self.known.get, words))
        at = np.array(found, np.int64)
        first, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(first - before, sizes) + np.arange(sizes.sum())]

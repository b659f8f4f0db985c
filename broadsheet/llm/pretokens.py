"""Splitting texts into the pre-tokens of a tokenizers file, fast for every script and exact for all.

The rule of a file is applied here by `re`, its classes of letters and numbers listed from the character database up
to U+FFFF. Characters beyond are symbols to the rule, as emoji are. A text with a letter or number beyond, with a
character that the database does not know, or with the string of an added token goes through the library's own encode().
A pre-token's ids do not depend on its neighbours, so they are looked up in a cache and encoded once.
"""

from __future__ import annotations

import itertools
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache

from tokenizers import Tokenizer

from .shared import held

_TOP = 0x10000
#: From here on no character is listed; all are left to the library.
_END = 0x32400


def _ranges(codes: Iterable[int]) -> str:
    """A character class's inside that lists these code points, which must ascend."""
    out: list[list[int]] = []
    for code in codes:
        if out and out[-1][1] == code - 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@cache
def _listed(kinds: str, first: int = 0, end: int = _TOP) -> str:
    """The code points whose major category is among kinds, or that are unassigned where kinds has a 0."""
    return _ranges(i for i in range(first, end) if (c := unicodedata.category(chr(i)))[0] in kinds or "0" in kinds and c in ("Cn", "Co", "Cs"))


# fixed values: the split rules of the two tokenizers files, with white space as the library has it
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RULES = {
    "word": "[{L}]+|'(?:[stmd]|re|ve|ll)|[{N}]|[^{S}{L}{N}]+",
    "byte": " ?[{L}]+|'(?:[stmd]|re|ve|ll)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+",
}
# end of fixed values


def _byte_letters() -> dict[int, str]:
    """Byte to the letter that stands for it in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PreTokens:
    """One tokenizer with its split rule; kind is `word` (composed and lower-cased first) or `byte`."""

    def __init__(self, path: str, kind: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        rule = _RULES[kind]
        # texts of one byte a character take classes that end there
        self.narrow: Callable[[str], list[str]] = re.compile(rule.format(L=_listed("L", 0, 256), N=_listed("N", 0, 256), S=_SPACE)).findall
        self.rule, self._wide = rule, None
        self.model, self.letters = self.library.model, _byte_letters()
        self.lower = kind == "word"
        self.added = [x.content for x in self.library.get_added_tokens_decoder().values()]

    def wide(self, text: str) -> list[str] | None:
        """The pre-tokens of any text, or None where only the library can tell."""
        if self._wide is None:
            self._wide = (
                re.compile(f"[{_listed('0')}{_listed('LN0', _TOP, _END)}{chr(_END)}-{chr(sys.maxunicode)}]").search,
                re.compile(self.rule.format(L=_listed("L"), N=_listed("N"), S=_SPACE)).findall,
            )
        odd, find = self._wide
        if odd(text):
            return None
        if self.lower:
            # the library lower-cases each letter by itself, str.lower() a final sigma by its place
            if unicodedata.is_normalized("NFC", text):
                return find(text.replace("Σ", "σ").lower())
            text = self.library.normalizer.normalize_str(text)
            if odd(text):
                return None
        return find(text)

    def split(self, text: str) -> list[str] | None:
        """The text's pre-tokens, or None where only the library can tell."""
        if any(x in text for x in self.added):
            return None
        try:
            text.encode("latin-1")  # a fast test; lower-casing stays within it
        except UnicodeEncodeError:
            return self.wide(text)
        return self.narrow(text.lower() if self.lower else text)

    def piece(self, token: str) -> list[int]:
        """The ids of one pre-token that split() gave, by the library's model alone."""
        return [x.id for x in self.model.tokenize(token.encode().decode("latin-1").translate(self.letters))]

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


class Cache(dict):
    """Pre-token to value within most_bytes, besides the entries it starts with; the older half goes when it is full."""

    #: What an entry takes besides its key and value, and the longest key that is kept.
    ENTRY, LONGEST = 100, 64

    def __init__(self, of: Callable[[str], object], most_bytes: int = 40 << 20, start: dict | None = None) -> None:
        super().__init__(start or {})
        self.of, self.most_bytes, self.bytes, self.first = of, most_bytes, 0, len(self)

    def _size(self, token: str, value: object) -> int:
        return self.ENTRY + sys.getsizeof(token) + sys.getsizeof(value)

    def __missing__(self, token: str) -> object:
        value = self.of(token)
        if len(token) <= self.LONGEST:
            if self.bytes >= self.most_bytes:
                for old in list(itertools.islice(self, self.first, self.first + (len(self) - self.first + 1) // 2)):
                    self.bytes -= self._size(old, self.pop(old))
            self[token] = value
            self.bytes += self._size(token, value)
        return value


def kept(path: str, kind: str, of: Callable[[PreTokens, str], object], name: str, start: dict | None = None) -> tuple[PreTokens, Cache]:
    """The rule and cache of this worker for a tokenizer and a kind of value; they outlive a task, until another operator holds something."""

    def make() -> tuple[PreTokens, Cache]:
        rule = PreTokens(path, kind)
        return rule, Cache(lambda token: of(rule, token), start=start)

    return held(("pre-tokens", path, kind, name), make)

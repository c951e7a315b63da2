"""Public tokenizer files, read once per Python process."""

from __future__ import annotations

import json
from functools import lru_cache


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=1)
def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Bytes that print stand for themselves; the others take the code points from 256 on, in order.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@lru_cache(maxsize=1)
def library_ranges() -> dict[str, list[tuple[int, int]]]:
    """Code points that the tokenizers library takes for letters (L), numbers (N) and white space (S).

    Asked of the library itself, since its Unicode tables are older than Python's.
    """
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)]))
    out = {}
    for name, pattern in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("S", r"\s+")):
        ranges: list[tuple[int, int]] = []
        for piece, _ in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            a, b = ord(piece[0]), ord(piece[-1])
            if a < 0xD800 <= b:
                ranges += [(a, 0xD7FF), (0xE000, b)]
            else:
                ranges.append((a, b))
        out[name] = ranges
    return out

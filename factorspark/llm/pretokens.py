"""Texts on which a faster way than the tokenizer itself is certain to be exact.

Texts made only of plain characters (ASCII, Latin letters and general punctuation) can be split with
``re``: on them letters, numbers and white space mean the same to ``re`` and to the tokenizer's own
rules, and composition to NFC changes nothing. Any other text, and one that spells a special token,
goes through the tokenizer itself.
"""

from __future__ import annotations

import os
import re
import sys
import types

# Latin letters and numbers up to U+024F, and the patterns of two public vocabularies.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
# without U+0130, whose lower case has two characters, without letters whose lower case is beyond U+024F
# (U+0181, U+023A and others), and without other line and space signs
LATIN = "".join(c for c in map(chr, range(0x131, 0x250)) if c.lower() <= "\u024f")
NOT_PLAIN = re.compile(rf"[^\t-\r\x20-\x7e\xa0-\u012f{LATIN}\u2010-\u2027\u2030-\u205e\u20ac]")
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_BPE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")


def is_plain(text: str, specials: tuple[str, ...]) -> bool:
    plain = text.isascii() and "\x1c" not in text and "\x1d" not in text and "\x1e" not in text and "\x1f" not in text
    return (plain or NOT_PLAIN.search(text) is None) and not any(special in text for special in specials)


def load_tokenizer(path: str):
    """A ``tokenizers`` file, without threads of its own beside Spark's tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> tuple[str, ...]:
    return tuple(token.content for token in tokenizer.get_added_tokens_decoder().values())


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker, over all the tasks it runs.

    Functions sent by value are new in every task, and so would be a cache of their own.
    """
    module = sys.modules.setdefault("factorspark_worker_state", types.ModuleType("factorspark_worker_state"))
    return module.__dict__.setdefault(name, {})

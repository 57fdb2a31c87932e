"""Token ids of whole texts by the ``tokenizers`` library, through a cache of text units.

A text is cut at places that no token crosses; each distinct unit is encoded once per worker and
the ids are joined as bytes.  Where a tokenizer allows that follows from its own settings:

* ``words``: white space is dropped before words are matched (a Split of lower-cased text):
  units are the runs between ASCII white space;
* ``spaces``: byte-level with the usual pattern, where a space joins the word after it: a unit
  starts at each space that follows a non-space character;
* any other tokenizer: the whole text is one unit and nothing is cached.

Letters followed by ASCII punctuation never share a token, so ``word,`` is composed of two
cached parts.  A run of letters is one word for the tokenizer's model, which is then asked
directly; everything else goes through the whole tokenizer.  The caches are emptied when they
reach ``CACHE_LIMIT`` entries, which bounds the memory of a worker and cannot change a result.
"""

from __future__ import annotations

import json
import re
from array import array

CACHE_LIMIT = 300_000
# ASCII punctuation without the apostrophe, which may start a token together with letters.
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters up to U+024F have the same case mapping and composed form everywhere; but for U+0130,
# whose lower case holds a combining mark.
_LAST_LETTER, _DOTTED = "\u024f", "\u0130"
_SPACE_AFTER_SPACE = re.compile(r"[\s\x1c-\x1f] ")
_UNIT_START = re.compile(r"(?<=[^\s\x1c-\x1f])(?= )")
_LINE_END = re.compile(r"(?<=[^\s\x1c-\x1f])\n(?=[^\s\x1c-\x1f])")


def cut_rule(settings: dict) -> str:
    pre, norm = settings.get("pre_tokenizer") or {}, settings.get("normalizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "spaces"
    first, *rest = pre.get("pretokenizers") or [{}]
    kinds = [n.get("type") for n in norm.get("normalizers", [])]
    if kinds == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split" and first.get("invert") \
            and first.get("behavior") == "Removed" and r"[\p{L}]+" in first["pattern"].get("Regex", "") \
            and [r.get("type") for r in rest] == ["ByteLevel"] and not rest[0].get("use_regex"):
        return "words"
    return "whole"


def byte_letters() -> str:
    """Byte-level tokenizers spell byte b as the b-th character of this string: printable Latin-1
    stands for itself, the other bytes take the code points from 256 on in turn."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    other = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(other)) for b in range(256))


class _Units(dict):
    """Unit -> ids; a missing unit is encoded on its first use."""

    def __init__(self, owner: "UnitEncoder", prefix: bytes):
        super().__init__()
        self.owner, self.prefix = owner, prefix
        self.lead = "".join(byte_letters()[b] for b in prefix)
        self.fold = owner.rule == "words"
        self.kind, self.tokenize = owner.kind, owner.tokenizer.model.tokenize

    def __missing__(self, unit: bytes) -> bytes:
        if not unit.isalpha():  # of bytes: ASCII letters only
            ids = self.owner.unit_ids(self, unit)
        elif self.fold and not unit.islower():
            ids = self[unit.lower()]
        else:  # ASCII letters spell themselves
            ids = array(self.kind, [t.id for t in self.tokenize(self.lead + unit.decode())]).tobytes()
        self[unit] = ids
        return ids


class UnitEncoder:
    def __init__(self, settings: str, kind: str = "I"):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(settings)
        self.rule, self.kind = cut_rule(json.loads(settings)), kind
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # units are cached here; the model's own cache only costs
        self.spelled = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.heads = _Units(self, b"")  # units as they stand
        self.tails = _Units(self, b" ")  # units after a space (rule "spaces")

    def _text_ids(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def unit_ids(self, known: _Units, unit: bytes) -> bytes:
        """Ids of a unit that is not just ASCII letters."""
        core = unit.rstrip(PUNCTUATION)
        if len(core) < len(unit) and core.isalpha():
            return known[core] + self.heads[unit[len(core):]]
        text = core.decode()
        if not (text.isalpha() and max(text) <= _LAST_LETTER and _DOTTED not in text):
            return self._mixed_ids(known, unit)
        lower = text.lower().encode() if known.fold else core
        if lower != core or len(core) < len(unit):
            ids = known[lower]
            return ids + self.heads[unit[len(core):]] if len(core) < len(unit) else ids
        spelling = known.lead + core.decode("latin-1").translate(self.spelled)
        return array(self.kind, [t.id for t in known.tokenize(spelling)]).tobytes()

    def _mixed_ids(self, known: _Units, unit: bytes) -> bytes:
        text = (known.prefix + unit).decode()
        if self.rule == "spaces" and "\n" in text:
            parts = _LINE_END.split(text)
            if len(parts) > 1:  # a line end between two words is a token of its own
                first = known[parts[0].encode()[len(known.prefix):]]
                return first + b"".join([self.heads[b"\n"] + self.heads[p.encode()] for p in parts[1:]])
        return self._text_ids(text)

    def encode(self, raw: bytes) -> bytes:
        """Ids of one UTF-8 text as unsigned integers in the machine's (little-endian) order."""
        if not raw:
            return b""
        if self.rule == "whole":
            return self._text_ids(raw.decode())
        for cache in (self.heads, self.tails):
            if len(cache) > CACHE_LIMIT:
                cache.clear()
        if self.rule == "words":
            return b"".join(map(self.heads.__getitem__, raw.split()))
        if _spaced(raw):
            return b"".join([self.heads[p.encode()] for p in _UNIT_START.split(raw.decode())])
        units = raw.split(b" ")
        return self.heads[units[0]] + b"".join(map(self.tails.__getitem__, units[1:]))


def _spaced(raw: bytes) -> bool:
    """Does some space follow another white-space character?"""
    if raw.isascii():
        return any(pair in raw for pair in (b"  ", b"\n ", b"\t ", b"\r ", b"\x0b ", b"\x0c ", b"\x1c ", b"\x1d ", b"\x1e ", b"\x1f "))
    return _SPACE_AFTER_SPACE.search(raw.decode()) is not None


def encoder(settings: str, kind: str = "I") -> UnitEncoder:
    """The worker process's encoder for these settings (kept across its tasks).  ``kind``: ids of
    32 bits (``I``) or of 16 (``H``)."""
    import multiprocessing
    kept = multiprocessing.current_process().__dict__.setdefault("_unit_encoders", {})
    if (settings, kind) not in kept:
        kept[settings, kind] = UnitEncoder(settings, kind)
    return kept[settings, kind]


def id_kind(settings: str) -> str:
    """``H`` if every id of the tokenizer fits into 16 bits, else ``I``."""
    from tokenizers import Tokenizer
    return "H" if max(Tokenizer.from_str(settings).get_vocab().values()) < 1 << 16 else "I"


def tokenizer_settings(path: str) -> str:
    """The tokenizer file's text, read on the driver and shipped with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()

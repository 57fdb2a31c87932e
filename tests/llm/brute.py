"""Brute-force versions of the operators, in plain Python over whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(sf_dir: str, name: str, *columns: str) -> list[tuple]:
    t = pq.read_table(f"{sf_dir}/{name}.parquet", columns=list(columns))
    return list(zip(*(t[c].to_pylist() for c in columns)))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def token_ids(name: str, texts: list[str | None]) -> list[bytes]:
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path(name)))
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes() for t in texts]


def fingerprint(text: str | None, k: int = 3) -> int:
    w = WORD.findall(ascii_lower(text or ""))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], bits: int = 2) -> dict[int, int]:
    """fingerprint -> a representative of everything reachable."""
    own = sorted(set(prints))
    root = {x: x for x in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(own):
        for b in own[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    return {x: find(x) for x in own}


def simhash(rows: list[tuple]) -> set[tuple]:
    prints = [fingerprint(t) for _, t in rows]
    find = components(prints)
    least: dict[int, int] = {}
    for (i, _), p in zip(rows, prints):
        least[find[p]] = min(i, least.get(find[p], i))
    return {(i, f"{p:016x}", least[find[p]]) for (i, _), p in zip(rows, prints)}


def repeated_bytes(raws: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        runs: list[tuple[int, int]] = []
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], i + length)
                else:
                    runs.append((i, i + length))
        out.append(runs)
    return out


def cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for s, e in runs:
        parts.append(raw[at:s])
        at = e
    return b"".join(parts) + raw[at:]


def check_packing(rows: list, expected: dict, size: int) -> int:
    """``expected``: id -> list of id strings (one per row of that id).  Returns the sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(expected)
    for doc, texts in expected.items():
        want = Counter()
        for ids in texts:
            n = len(ids) // 4
            at, piece, stop = 0, 0, n % size or size
            while at < n:
                want[piece, at, stop - at, zlib.crc32(ids[4 * at:4 * stop])] += 1
                at, stop, piece = stop, stop + size, piece + 1
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc]) == want
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_seq)


def normal_sha(text: str | None) -> str:
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()

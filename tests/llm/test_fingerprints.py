"""Fingerprints of texts against a plain loop."""

import pyarrow as pa
import xxhash

from velostat.llm import simhash
from velostat.llm.common import text_blocks


def plain_fingerprint(text, size=4):
    w = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    shingles = [b" ".join(w[k : k + size]) for k in range(max(len(w) - size + 1, min(len(w), 1)))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_against_a_plain_loop():
    texts = ["a b c d e f", "A  b\tC d\ne F", "one", "", None, " \n", "x y z", "Ünï çä 日本 ÀÉ ab cd", "word " * 500, "p q r s t u v w x y z " * 9]
    for limit in (1 << 21, 16):
        got = [f for block in text_blocks(pa.array(texts), limit) for f in simhash.block_fingerprints(block, 4).tolist()]
        assert got == [plain_fingerprint(t) for t in texts]

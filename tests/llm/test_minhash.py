"""Fingerprints held digit by digit to a plain one-permutation MinHash with optimal densification."""

import hashlib
import random

import xxhash


def plain(text: str, bins: int = 128, bits: int = 8, n: int = 5) -> str:
    words = text.lower().split()
    # fewer words than a shingle has are one shingle
    runs = [words[i : i + n] for i in range(len(words) - n + 1)] or ([words] if words else [])
    smallest = {}
    for run in runs:
        h = 42
        for w in run:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        h >>= 1
        k = h >> 56
        smallest[k] = min(h, smallest.get(k, h))
    digits = []
    for j in range(bins):
        order = sorted(range(bins), key=lambda k: hashlib.blake2b(f"{j}/{k}".encode(), digest_size=8).digest())
        found = smallest.get(j)
        if found is None:
            found = next((smallest[k] for k in order if k in smallest), (1 << bits) - 1)
        digits.append(f"{found & ((1 << bits) - 1):02x}")
    return "".join(digits)


def test_fingerprints_digit_by_digit(spark):
    from palaver.llm import fingerprint

    rng = random.Random(6)
    words = [f"w{k}" for k in range(500)]
    texts = ["", "one", "one two three", "a b c d e", "A  B\tC\nD e", "x " * 900]
    texts += [" ".join(rng.choice(words) for _ in range(n)) for n in (4, 5, 6, 10, 40, 127, 128, 129, 600, 5000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(frame).collect()}
    assert {k: got[k] for k in got} == {k: plain(t) for k, t in enumerate(texts)}


def test_edited_fingerprints_and_likeness(spark):
    from palaver.llm import fingerprint

    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 300))) for _ in range(60)] + [""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)

    def like(a, b):
        same = sum(a[i : i + 2] == b[i : i + 2] for i in range(0, 256, 2)) / 128
        return max(0.0, (same - 1 / 256) / (1 - 1 / 256))

    for r in fingerprint.digest(frame).collect():
        own, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        cut = len(own) // 4
        edited = own[: len(own) - cut] + after[:cut]
        assert (r.fingerprint, r.edited_fingerprint) == (plain(own), plain(edited))
        assert abs(r.near_edited - like(plain(own), plain(edited))) < 1e-12
        assert abs(r.near_next - like(plain(own), plain(after))) < 1e-12

import random
from collections import Counter
from os.path import commonprefix

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scriptorium.llm import avi, language_id, line_crf, lcp_merge, media, minhash, mixing, packing, suffix_dedup, tokens

WORDS = ["the", "of", "École", "l'été", "word,", "x!!", "naïve", "a\x1cb", "<|endoftext|>", "İstanbul", "ΣΑΣ", "123", "don't", "…", "ét", "　", "ﬁn", ""]


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.WordTokenizer(tokens.tokenizer_path(), max_words=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS) | st.text(max_size=6), max_size=12).map(" ".join), min_size=1, max_size=5))
def test_ids_are_the_tokenizers(tokenizer, texts):
    flat, counts = tokenizer.encode(texts)
    whole = [tokenizer.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert flat.tolist() == [i for ids in whole for i in ids] and counts.tolist() == list(map(len, whole))
    assert tokenizer.lengths(texts).tolist() == list(map(len, whole))


@given(st.lists(st.lists(st.binary(max_size=12), max_size=12), max_size=7))
def test_merge_knows_prefixes(runs):
    runs = [sorted(set(r)) for r in runs]
    out = list(lcp_merge.merged([lcp_merge.front_coded(r, [1] * len(r)) for r in runs]))
    assert [s for _, _, s, _ in out] == sorted(s for r in runs for s in r)
    last = b""
    for _, known, s, _ in out:
        assert known == len(commonprefix([last, s]))
        last = s


def test_merge_never_compares_known_prefixes(monkeypatch):
    """Each byte of a string is compared once on its way out, besides one byte a comparison."""
    seen = []
    real = lcp_merge.shared
    monkeypatch.setattr(lcp_merge, "shared", lambda a, b, start=0: seen.append((start, k := real(a, b, start))) or k)
    runs = [[b"x" * 50 + bytes([i, j]) for j in range(20)] for i in range(8)]
    coded = [lcp_merge.front_coded(r, [1] * 20) for r in runs]
    seen.clear()
    assert len(list(lcp_merge.merged(coded))) == 160
    assert sum(k - start for start, k in seen) <= 8 * 52 + 160


def test_cells_cover_all_windows():
    random.seed(2)
    texts = [bytes(random.choices(b"ab ", k=random.randint(0, 300))) for _ in range(30)]
    owner, start, windows, before, grams, names = suffix_dedup.cells(texts, 20, 10)
    assert windows.sum() == sum(max(0, len(t) - 19) for t in texts)
    by_gram = {}
    for k in range(len(owner)):
        for w in range(windows[k]):
            piece = texts[owner[k]][start[k] + w : start[k] + w + 20]
            assert by_gram.setdefault(piece, grams[k]) == grams[k]  # equal windows, equal grams
        assert 0 <= before[k] - windows[k] + 1 and before[k] <= 10  # the gram lies in all windows of the cell


@given(st.lists(st.tuples(st.binary(max_size=4), st.binary(min_size=4, max_size=8), st.integers(1, 2)), min_size=1, max_size=12, unique_by=lambda c: c[:2]))
def test_common_prefixes_tell_what_repeats(made):
    """Windows of 8 bytes around a gram of 4, by both orders' common prefixes, against all pairs."""
    made = sorted(((b"gram" + after)[: 4 + len(after)], before, n) for before, after, n in made)
    common = [0] + [len(commonprefix([a[0], b[0]])) for a, b in zip(made, made[1:])]
    again = suffix_dedup.repeated_windows(np.array(common), np.array([len(s) for s, _, _ in made]), [b for _, b, _ in made], np.array([n for _, _, n in made]), 8, 4)
    piece = lambda c, k: (c[1][:k], c[0][: 8 - k]) if len(c[1]) >= k and len(c[0]) >= 8 - k else None
    for k in range(5):
        times = Counter(p for c in made for p in [piece(c, k)] * c[2] if p)
        assert [bool(x) for x in again[k]] == [times[piece(c, k)] > 1 for c in made]


def test_cut():
    assert suffix_dedup.cut(b"abcdefgh", [(1, 3), (2, 4), (6, 7)]) == (4, 2, b"aefh")
    assert suffix_dedup.cut(b"abcd", [(0, 2), (2, 4)]) == (4, 1, b"")
    assert suffix_dedup.cut(b"", []) == (0, 0, b"")


@settings(deadline=None)
@given(st.lists(st.binary(max_size=700), min_size=1, max_size=6))
def test_avi_round_trip(raw):
    payloads = [media.padded(r) for r in raw]
    assert [p for p, _ in avi.decode(avi.encode(payloads))] == payloads


def test_avi_is_riff_with_frames():
    data = avi.encode([bytes(range(256)) * 16])[0]
    frames, payload = avi.indexed(data)
    assert data[:4] == b"RIFF" and int.from_bytes(data[4:8], "little") == len(data) - 8 and payload == 4096
    assert len(frames) == 4 and all(f[:2] == b"\xff\xd8" and f[-2:] == b"\xff\xd9" for f in frames)
    with pytest.raises(ValueError):
        avi.indexed(b"RIFF0000WAVE")
    broken = bytearray(frames[0])
    broken[-2:] = b"\xff\xd3"
    with pytest.raises(ValueError):
        avi.decoded_lines([bytes(broken)])


def test_shots_by_histogram():
    dark, light = np.zeros((5, 16, 64), np.uint8), np.full((4, 16, 64), 200, np.uint8)
    assert media.shots(np.concatenate([dark, light])) == [(0, 5), (5, 9)]
    assert media.shots(dark[:1]) == [(0, 1)]


def test_shingles():
    a, b, c, d, e = minhash.shingle_sets(["A b  c\td e", "a B c d e", "one two", "", "one two three four"], 4)
    assert len(a) == 2 and (a == b).all() and len(c) == 1 and len(d) == 0 and len(e) == 1
    long = " ".join(f"w{i % 7}" for i in range(100))
    assert len(minhash.shingle_sets([long], 4)[0]) == 7


def test_estimate_follows_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, np.uint64)
    for keep in (400, 300, 100):
        other = np.concatenate([base[:keep], rng.integers(0, 1 << 63, 400 - keep, np.uint64)])
        x, y = minhash.packed(minhash.minima(np.sort(base))), minhash.packed(minhash.minima(np.sort(other)))
        lanes = np.uint64(sum(1 << k for k in range(0, 64, 4)))
        d = x ^ y
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        off = sum(bin(int(v & lanes)).count("1") for v in d)
        guess = ((1 - off / minhash.MINIMA) - 1 / 16) / (15 / 16)
        assert abs(guess - keep / (800 - keep)) < 0.12


def test_block_links():
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 5, 50, 1000)]
    rows = [{"rep": k, "component": k, "shingles": s.tobytes()} for k, s in enumerate(sets)]
    assert minhash.block_links(rows[1:2], rows, 80) == [(0, 1)]
    assert minhash.block_links(rows[2:], rows, 80) == []


def test_raking_meets_marginals():
    cells = [("a", "x", "0", 10.0), ("a", "y", "0", 40.0), ("b", "x", "1", 30.0), ("b", "y", "0", 20.0), ("b", "y", "1", 5.0)]
    raked = mixing.rake(cells, ({"a": 0.5, "b": 0.5}, {"x": 0.3, "y": 0.7}, {0: 0.6, 1: 0.4}), 200)
    share = lambda d, v: sum(w for c, w in zip(cells, raked, strict=True) if c[d] == v)
    assert abs(share(0, "a") - 0.5) < 1e-6 and abs(share(1, "x") - 0.3) < 1e-6 and abs(share(2, "1") - 0.4) < 1e-6
    tokens_ = np.array([c[-1] for c in cells])
    p = mixing.probabilities(tokens_, raked, 0.4)
    assert abs((p * tokens_).sum() - 0.4 * tokens_.sum()) < 1e-6 and p.max() <= 1
    assert mixing.probabilities(tokens_, raked, 5.0).min() == 1


def test_packer_fills_windows():
    rng = np.random.default_rng(3)
    texts = [rng.integers(2, 50, n).astype(np.uint16) for n in (1, 5, 64, 200, 63, 7, 1, 30)]
    pieces = packing.Packer(texts, np.ones(64, np.float32), 40.0, 64).pack()
    covered = {k: sorted((a, a + n) for d, a, n, _, _ in pieces if d == k) for k in range(len(texts))}
    for k, t in enumerate(texts):
        ends = [0] + [b for _, b in covered[k]]
        assert [a for a, _ in covered[k]] == ends[:-1] and ends[-1] == len(t)
    sums = Counter()
    for _, _, n, s, offset in pieces:
        assert offset == sums[s]
        sums[s] += n
    assert sorted(sums.values())[1:] == [64] * (len(sums) - 1)


def test_packer_prefers_like_documents():
    a, b = np.arange(2, 12, dtype=np.uint16), np.arange(30, 40, dtype=np.uint16)
    pieces = packing.Packer([a, b, a.copy()], np.ones(64, np.float32), 10.0, 20).pack()
    assert [p[0] for p in pieces if p[3] == 0] == [0, 2]


def test_backoff_to_shorter_grams():
    model = {"languages": ["de", "en"], "sums": {(lang, k): 10 for lang in ("de", "en") for k in range(6)}, "items": "the\nder\nsch\nng", "lang": np.array([1, 0, 0, 1]), "size": np.array([0, 0, 3, 2]), "n": np.array([5, 5, 4, 3])}
    scorer = language_id.Scorer(model)
    assert scorer.predict(["the the", "der", "xschx", "zzng", "", "123 ..."]) [0] == ["en", "de", "de", "en", "und", "und"]
    assert scorer.predict([""])[1] == [0.0]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(4)
    counts, pairs = np.array([3, 1, 4]), rng.normal(size=(2, 2))
    scores = rng.normal(size=8)
    good, sums = line_crf.marginals(scores, counts, pairs)
    expected, pair_sums, at = [], np.zeros((2, 2)), 0
    for n in counts:
        weights = {}
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            weights[tuple(y)] = np.exp(sum(scores[at + i] * y[i] for i in range(n)) + sum(pairs[y[i], y[i + 1]] for i in range(n - 1)))
        z = sum(weights.values())
        expected += [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)]
        for y, w in weights.items():
            for i in range(n - 1):
                pair_sums[y[i], y[i + 1]] += w / z
        at += n
    assert np.allclose(good, expected) and np.allclose(sums, pair_sums)


def test_line_features_see_neighbours():
    x, size, counts = line_crf.features(["a b c\nXX YY!!\na a a a", ""])
    assert counts.tolist() == [3, 1] and x.shape == (4, 36) and (x[1, :12] == x[0, 24:]).all() and (x[0, 12:24] == 0).all() and (x[2, 24:] == 0).all()
    assert x[2, 9] > 0 and x[3, 11] == 1

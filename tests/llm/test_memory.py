"""What workers remember is bounded in bytes."""

import numpy as np

from heldout.llm import common


def _resident():
    with open("/proc/self/status") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("VmRSS")) / 1024


def test_words_are_hashed_alike_wherever_they_stand_and_not_kept():
    draw = np.random.default_rng(3)
    pool = [b"a", b"aa", b"ab", b"\xc3\xa9", b"\x1f", b"x" * 64, b"x" * 65, b"y" * 700_000, b"\xa0", b"\x85"] + [b"w%d" % i for i in range(500)]
    gaps = [b" ", b"\n", b"\t\r", b"  ", b"\x0b\x0c"]
    texts, want = [b"", b" ", b"\n\n"], [[], [], []]
    for _ in range(300):
        words = [pool[i] for i in draw.integers(0, len(pool), draw.integers(0, 40))]
        texts.append(gaps[draw.integers(5)].join(words) + draw.choice([b"", b" "]))
        want.append(words)
    (one, two), at = common.word_hashes(texts, 2)
    names = {}
    for i, words in enumerate(want):
        assert texts[i].split() == words and at[i + 1] - at[i] == len(words)
        for word, pair in zip(words, zip(one[at[i]:at[i + 1]].tolist(), two[at[i]:at[i + 1]].tolist())):
            assert names.setdefault(word, pair) == pair
    assert len({a for a, _ in names.values()}) == len({b for _, b in names.values()}) == len(names) and all(a != b for a, b in names.values())
    before = _resident()
    for i in range(0, 100_000, 50):
        common.word_hashes([b"%d" % (i + j) + b"x" * 20_000 for j in range(50)])
    assert _resident() - before < 50


def test_chunks_are_remembered_up_to_a_number_of_bytes():
    asked = []

    def encode(chunks):
        if asked is not None:
            asked.extend(chunks)
        return np.concatenate([np.frombuffer(c, dtype=np.uint8) for c in chunks]).astype(np.int64), np.array([len(c) for c in chunks])

    memory = common.Memory(encode)
    draw = np.random.default_rng(1)

    def check(chunks):
        flat, size = memory.ids(chunks, len(chunks))
        assert flat.astype(np.uint8).tobytes() == b"".join(chunks) and size.tolist() == list(map(len, chunks))

    check([b"a", b"long" * 30, b"b", b"a", b"long" * 30, b"other" * 40, b"b"])
    assert asked == [b"a", b"b", b"long" * 30, b"long" * 30, b"other" * 40]
    for _ in range(50):
        check([bytes([97 + i % 26]) * int(n) for i, n in enumerate(draw.integers(1, 200, 300))])
    asked = None
    before = _resident()
    for i in range(0, 100_000, 50):
        chunks = [b"%d" % (i + j) + b"x" * 20_000 for j in range(50)] + [b"short%d" % (i + j) for j in range(50)]
        memory.ids(chunks, len(chunks))
    assert _resident() - before < 100
    assert len(memory._numbers) > 90_000

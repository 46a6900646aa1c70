"""Very long texts: read in pieces, with the results of the whole text and
bounded memory."""
import random
import subprocess
import sys

import numpy as np
import pytest

from laborlens.llm import bit_planes, language_id, simhash, token_counts
from laborlens.llm.common import token_file

from . import brute


def texts():
    rng = random.Random(2)
    words = ["the", "of", "don't", "Straße", "ΑΣ", "ΣΑΣ,", "naïve", "日本語", "42", "--", "é", "\x1c", "a\x1db", "<|x|>", "▁"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", "　", ", ", " - ", "\x0b"]
    out = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(n)) for n in (50, 900, 2500)]
    return [*out, "x" * 700, " " * 500, "x" * 300 + " " + "y" * 300, " lead", "one two", "w", "", out[1].replace("\x1c", "").replace("\x1d", "")]


@pytest.mark.parametrize("size", [1, 7, 64, 333])
def test_language_evidence_by_strips(monkeypatch, size):
    for t in texts():
        whole, _ = language_id.grams([t])
        strips = list(language_id.strip_grams(t, size))
        got = np.concatenate(strips) if strips else np.empty(0, np.uint64)
        assert sorted(got.tolist()) == sorted(whole.tolist())


def test_long_texts_are_decided_alike(monkeypatch):
    rng = np.random.default_rng(0)
    model = language_id.Model(["a", "b", "c"], rng.integers(0, 8, (1 << 12, 1)).astype(np.uint64), np.array([0.2, 0.2, 0.2]), 2)
    want = language_id.decide(model, texts())
    monkeypatch.setattr(language_id, "STRIP", 100)
    assert language_id.decide(model, texts()) == want


@pytest.mark.parametrize("size", [1, 50, 400])
def test_fingerprints_by_pieces(monkeypatch, size):
    raw = [t.encode() for t in texts()]
    want = [simhash.fingerprint(t) for t in raw]
    monkeypatch.setattr(simhash, "PIECE", size)
    monkeypatch.setattr(simhash, "STRIP", 16)
    assert [simhash.fingerprint(t) for t in raw] == want
    assert [simhash.fingerprint(memoryview(t), 1) for t in raw] == [simhash.fingerprint(t, 1) for t in raw]


def test_token_counts_by_units(monkeypatch):
    lengths = token_counts.PieceLengths(token_file("piece_bpe_32k.model"))
    want = [len(lengths.model.encode(t)) for t in texts()]
    monkeypatch.setattr(token_counts, "LONG", 20)
    assert [lengths.counts([t])[0] for t in texts()] == want


@pytest.mark.parametrize("size", [1, 30, 1000])
def test_word_ids_by_pieces(monkeypatch, size):
    ids = bit_planes.WordIds(token_file("word_bpe_49k.json"))
    want = [ids.tokenizer.encode(t, add_special_tokens=False).ids for t in texts()]
    monkeypatch.setattr(bit_planes, "LONG", size)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.ids(texts())] == want
    assert brute


CALLS = {
    "op1": "from laborlens.llm import token_counts as m; from laborlens.llm.common import token_file\n"
           "x = m.PieceLengths(token_file('piece_bpe_32k.model')); run = lambda t: x.counts([t])",
    "op2": "from laborlens.llm import bit_planes as m; from laborlens.llm.common import token_file\n"
           "x = m.WordIds(token_file('word_bpe_49k.json')); run = lambda t: x.ids([t])",
    "op3": "from laborlens.llm import simhash as m\nrun = lambda t: m.fingerprint(t.encode())",
    "op8": "import numpy as np\nfrom laborlens.llm import language_id as m\n"
           "x = m.Model(['a', 'b'], np.ones((1 << 20, 1), np.uint64), np.array([0.1, 0.1]), 2); run = lambda t: m.decide(x, [t])",
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_memory_of_a_text_of_64_mb(name):
    """The peak while one text of 64 MB is worked on, the text included."""
    code = (f"{CALLS[name]}\nimport resource, random\nrng = random.Random(1)\n"
            "words = [''.join(rng.choices('abcdefghijklmnop', k=rng.randint(1, 9))) for _ in range(5000)]\n"
            "line = ' '.join(rng.choices(words, k=20000)); run(line)\n"
            "text = (line + ' ') * ((64 << 20) // (len(line) + 1) + 1); assert len(text) >= 64 << 20\n"
            "run(text); print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=None)
    assert int(out.stdout.split()[-1]) < 600

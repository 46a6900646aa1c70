"""Plain versions of the corpus operators, for small inputs."""
from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import xxhash


def roots(n, links):
    """Smallest index reachable from each of n."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def token_counts(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    for d, t in docs:
        n = len(sp.encode(t or ""))
        yield d, len((t or "").encode()), n, n > 4096


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path(name)))
    t.no_truncation()
    t.no_padding()
    return t


def token_ids(docs):
    tk, start = tokenizer("word_bpe_49k.json"), 0
    for d, t in sorted(docs, key=lambda x: (x[0], x[1] or "")):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 2]
        yield d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def codec(docs):
    tk = tokenizer("byte_bpe_50k.json")
    for d, t in docs:
        ids = tk.encode(t or "", add_special_tokens=False).ids
        yield d, len(ids), sha(",".join(map(str, ids))), sha(tk.decode(ids, skip_special_tokens=False))


def simhash(docs, size=3, most=2):
    prints = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sh = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    order = sorted(range(len(docs)), key=lambda i: docs[i][0])
    p = [prints[i] for i in order]
    r = roots(len(p), [(i, j) for i in range(len(p)) for j in range(i) if (p[i] ^ p[j]).bit_count() <= most])
    return [(docs[i][0], f"{prints[i]:016x}", docs[order[r[k]]][0]) for k, i in enumerate(order)]


def chat(rows, learned="assistant"):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == learned)
        yield c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def contamination(docs, items, size=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + size]), set()).add(str(i))
    lens = {len(k) for k in wins}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for s in range(len(w)):
            for n in lens:
                if s + n <= len(w) and tuple(w[s:s + n]) in wins:
                    hit.update(range(s, s + n))
                    ids |= wins[tuple(w[s:s + n])]
        yield d, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)


def vectors(rows, least=0.95):
    """Exact links over all pairs."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], float) / max(map(abs, rows[i][1])) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    at = {i: k for k, i in enumerate(order)}
    links = [(i, j) for i in ok for j in ok if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least]
    n = np.bincount([x for p in links for x in p], minlength=len(rows)) if links else np.zeros(len(rows), int)
    r = roots(len(rows), [(at[a], at[b]) for a, b in links])
    return [(rows[i][0], int(n[i]), rows[order[r[at[i]]]][0], rows[order[r[at[i]]]][0] == rows[i][0]) for i in range(len(rows))]


def repeats(docs, length=100):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(b[s:s + length])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def archives(pages, least=1000):
    last = {}
    for p, h in pages:
        b = (h or "").encode()
        if len(b) >= least:
            last[b] = max(p, last.get(b, p))
    for p, h in pages:
        b = (h or "").encode()
        keep = last.get(b, p)
        yield p, len(b), hashlib.sha1(b).hexdigest(), "response" if keep == p else "revisit", None if keep == p else keep

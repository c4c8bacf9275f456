"""Plain Python forms of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def spans(found):
    order = ["email", "ip", "card", "phone", "term", "assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (s[1], order.index(s[0]))))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    t, out = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key += "|[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t):
        if len(m[2]) >= 12:
            out.append(("assign", *m.span()))
    for m in re.finditer("AKIA[A-Z0-9]+", t):
        if len(m[0]) >= 18:
            out.append(("access", *m.span()))
    for m in re.finditer("[0-9a-f]+", t):
        if len(m[0]) >= 16:
            out.append(("hex", *m.span()))
    return out


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    ws = _WORDS.findall(lowered(text))
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(len(ws) - 3, 1))] if ws else []
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def groups(fps: dict):
    """Smallest id reachable by links of 4 or fewer bits."""
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] > label[j]:
                    label[i], changed = label[j], True
    return label


def hits(text, items: dict):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    ws = word.findall(lowered(text))
    hit, found = set(), set()
    for item, body in items.items():
        pattern = word.findall(lowered(body))
        m = min(10, len(pattern))
        wanted = {tuple(pattern[k : k + m]) for k in range(len(pattern) - m + 1)} if pattern else set()
        for i in range(len(ws) - m + 1):
            if tuple(ws[i : i + m]) in wanted:
                hit.update(range(i, i + m))
                found.add(str(item))
    return len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def repeats(docs: dict):
    """{doc_id: (n_bytes, n_removed, n_spans, sha of the rest)}"""
    seen, out = set(), {}
    for i in sorted(docs):
        raw = (docs[i] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\x01" * 100
            seen.add(w)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), runs, sha(rest))
    return out


def quality(text):
    t = text or ""
    ws = _WORDS.findall(t)
    lines = [x for x in t.split("\n") if _WORDS.search(x)]
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    repeat = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    n = len(ws)
    failed = n < 50 or 100 * len(repeat) > 50 * n
    return n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeat), failed


def depleted(rows: list, min_docs: int, share: float, keep: float) -> list[tuple]:
    """(removed places, kept) of each (doc_id, host, text), by frequency of lines in the distinct texts of a host."""
    def norm(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")

    hosts: dict = {}
    for _, host, text in rows:
        hosts.setdefault(host, set()).add(text or "")
    often = {}
    for host, texts in hosts.items():
        count = Counter(line for t in texts for line in {norm(x) for x in t.split("\n")} if line)
        often[host] = {x for x, n in count.items() if n > min_docs and n > share * len(texts)}
    out = []
    for _, host, text in rows:
        lines = [norm(x) for x in (text or "").split("\n")]
        gone = [i for i, x in enumerate(lines) if x in often[host]]
        n, cut = len(_WORDS.findall(text or "")), sum(len(lines[i].split(" ")) for i in gone)
        out.append((gone, not quality(text)[5] and n - cut >= keep * n))
    return out


def phrases(rows, least, top):
    """rows (lang, text) -> sorted (lang, rank, phrase, a, l, r, n, score)"""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(ws)
            count.update((lang, *ws[i : i + m]) for m in range(1, 5) for i in range(len(ws) - m + 1))
    cands = {k: a for k, a in count.items() if len(k) > 2 and a >= least}
    by_lang: dict = {}
    for (lang, *ws), a in cands.items():
        inside = any(
            100 * b >= 80 * a and any(list(other[i : i + len(ws)]) == ws for i in range(1, len(other) - len(ws) + 1))
            for other, b in cands.items()
            if other[0] == lang and len(other) > len(ws) + 1
        )
        if not inside:
            cuts = [(count[lang, *ws[:k]], count[lang, *ws[k:]]) for k in range(1, len(ws))]
            score, _, (left, right) = min((2_000_000 * a // (x + y), k, (x, y)) for k, (x, y) in enumerate(cuts))
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def divergence(rows, least_docs, top=10):
    """rows (text, lang, source) -> sorted (lang, source, part, item, value, rank)"""
    n, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lowered(text))
        n.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (k, t), d in docs.items() if k == lang and d >= least_docs]
        sources = sorted(s for k, s in groups if k == lang)
        count = {s: {t: n[lang, s, t] for t in kept} for s in sources}
        all_n = {t: sum(count[s][t] for s in sources) for t in kept}

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (x + 2) // total for t, x in c.items()}

        p, q = {s: shares(count[s]) for s in sources}, shares(all_n)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)

"""Plain Python versions of the operators' contracts, for small frames."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """(doc_id, text) -> doc_id: (keep_id, group_size, kept, sha); ids distinct."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[sha(re.sub(SPACE, "", text or ""))].append((-len(text or ""), doc))
    out = {}
    for digest, members in groups.items():
        keep = min(members)[1]
        for _, doc in members:
            out[doc] = (keep, len(members), doc == keep, digest)
    return out


def shingles(text):
    words = re.findall(WORD, (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near(rows):
    """doc_id: (n_shingles, component_id)."""
    sets = {doc: shingles(text) for doc, text in rows}
    index, parent = defaultdict(list), {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc in sorted(sets):
        common = Counter()
        for s in sets[doc]:
            common.update(index[s])
            index[s].append(doc)
        for other, both in common.items():
            if 100 * both >= 80 * (len(sets[doc]) + len(sets[other]) - both):
                a, b = root(doc), root(other)
                parent[max(a, b)] = min(a, b)
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def substrings(rows, length=50):
    """doc_id: (n_bytes, n_removed, n_spans, sha of what stays)."""
    first = {}
    for doc, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < doc:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def best_fit(lengths, capacity):
    """Rooms left in the sequences of best-fit decreasing, by trying every open one."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def first_lines(rows, least_sentence=50):
    """doc_id: spans of the lines, and of long sentences in lines that stay, that came before."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        out[doc], at = [], 0
        for line in (text or "").split("\n"):
            parts, start = [], at
            for part in re.findall(r".*?[.!?]\s+|.+?$", line, re.DOTALL):
                parts.append((start, start + len(part.rstrip()), part))
                start += len(part)
            units = [(at, at + len(line), line, 1)]
            if sum(bool(p.strip()) for *_, p in parts) > 1:
                units += [(*p, least_sentence) for p in parts]
            line_gone = False
            for n, (a, b, unit, least) in enumerate(units):
                norm = " ".join(unit.lower().split())
                if len(norm) < least:
                    continue
                if norm in seen:
                    line_gone |= n == 0
                    if n == 0 or not line_gone:
                        out[doc].append((a, b))
                seen.add(norm)
            at += len(line) + 1
    return out


def fingerprint(text):
    """SimHash of a text, bit by bit."""
    import xxhash

    words = re.findall(WORD, (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(grams))


def linked(prints, differ=2):
    """{id: fingerprint} -> {id: smallest id reachable}, by trying all pairs."""
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= differ:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def lloyd(rows, parts=8, entries=16, rounds=6):
    """[(vec_id, integers)] in the order of the codebooks' start -> codes, errors, codebooks."""
    width = len(rows[0][1]) // parts
    pieces = [[v[p * width : p * width + width] for p in range(parts)] for _, v in rows]
    books = [[list(piece[p]) for piece in pieces[:entries]] for p in range(parts)]

    def nearest(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for piece in pieces:
                members[nearest(piece[p], books[p])[1]].append(piece[p])
            for i, own in members.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(piece[p], books[p]) for p in range(parts)] for piece in pieces]
    return [bytes(i for _, i in f).hex() for f in found], [sum(d for d, _ in f) for f in found], books


def divergence(rows, least=10, top=10):
    """[(lang, source, text)] -> sorted (lang, source, part, item, value, rank)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    uses, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        uses[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = {r[1] for r in rows if r[0] == lang}
        counts = {s: [uses[lang, s][t] for t in kept] for s in sources}
        every = [sum(c) for c in zip(*counts.values())]

        def shares(c):
            return [1 + 10**9 * (n + 2) // (sum(c) + 2 * len(kept)) for n in c]

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(every)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [("pair", o, sum(map(f, p[s], p[o]))) for o in sources if o != s]
            terms = [("term", t, f(a, b)) for t, n, a, b in zip(kept, counts[s], p[s], q) if n and a > b]
            for part in (pairs, sorted(terms, key=lambda x: (-x[2], x[1].encode()))[:top]):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, *x, i + 1) for i, x in enumerate(part)]
    return sorted(out)


def decoded_spans(text):
    """(start, kind, end) of secrets in a text and in all that it decodes to, by trying every escape and every
    base64 run of every layer, one level at a time; each character knows the stretch it comes from."""
    import base64
    import gzip
    import html

    escape = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
    found, seen = set(), set()
    work = [[(c, i, i + 1) for i, c in enumerate(text)]]
    while work:
        layer = work.pop()
        s = "".join(c for c, _, _ in layer)
        key = (s, layer[0][1], layer[-1][2]) if layer else None
        if key is None or key in seen:
            continue
        seen.add(key)
        found |= {(layer[a][1], k, layer[b - 1][2]) for a, k, b in base_secrets(s)}
        child, at = [], 0
        for m in escape.finditer(s):
            child += layer[at : m.start()]
            x = m[0]
            c = html.unescape(x) if x[0] == "&" else chr(int(x[1:] if x[0] == "%" else x[2:], 16))
            child += [(c, layer[m.start()][1], layer[m.end() - 1][2])]
            at = m.end()
        if at:
            work.append(child + layer[at:])
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}={0,2}", s):
            run = m[0].rstrip("=").replace("-", "+").replace("_", "/")
            run = run[: len(run) - (len(run) % 4 == 1)]
            raw = base64.b64decode(run + "=" * (-len(run) % 4))
            if raw[:2] == b"\x1f\x8b":
                try:
                    raw = gzip.decompress(raw)
                except OSError:
                    pass
            a, b = layer[m.start()][1], layer[m.end() - 1][2]
            work.append([(c, a, b) for c in raw.decode("utf-8", "replace")])
    return found


def differencing(sizes, shards):
    """Karmarkar-Karp: the two partitions of largest spread are laid on each other in opposite order, until one is left."""
    parts = [(-size, i, [size] + [0] * (shards - 1)) for i, size in enumerate(sizes)]
    n = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: p[:2])
        (_, _, a), (_, _, b), *parts = parts
        both = [x + y for x, y in zip(sorted(a, reverse=True), sorted(b))]
        parts.append((min(both) - max(both), n, both))
        n += 1
    return sorted(parts[0][2])

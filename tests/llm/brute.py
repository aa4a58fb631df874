"""Plain Python versions of what the corpus queries must return."""
import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(rows, bits=4):
    """rows: (id, text). Returns sorted (id, fingerprint hex, component id)."""
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [(d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows)]


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def luhn(d):
    s = 0
    for i, x in enumerate(reversed(d)):
        v = int(x) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def pii(text):
    t = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def tokenizer(path):
    import public_tokenizers as P
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe(text, enc):
    ids = enc.encode_ordinary(text or "")
    return len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(enc.decode_bytes(ids))


def targets(sizes, weights=(5, 2, 1), cap=3):
    """sizes: source (may be None) -> words. Returns source -> target."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > cap * sizes[s]}
        if not over:
            return {**t, **{s: float(cap * sizes[s]) for s in full}}
        full |= over


def by_source(rows):
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    return dict(sizes)


def damaged(rows):
    """Rows (conv, turn, role, text) of conversations after damage: conv -> rows in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out[conv]
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fate == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def repaired(rows):
    """Report of one conversation's ordered rows: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)."""
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    tables = [{state: (0, "", ()) for state in ("", "a")}]  # from each state to the end: (cost, audit, turns)
    name = {"u": "user", "a": "assistant"}

    def with_inserts(table):
        for _ in range(3):
            more = dict(table)
            for (state, x), to in follow.items():
                if x in name and to in table:
                    cost, audit, left = table[to]
                    more[state] = min(more.get(state, (10**9,)), (cost + 3, "I" + audit, ((name[x], ""), *left)))
            table = more
        return table
    table = with_inserts(tables[0])
    for (_, role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        new = {}
        for state, (cost, audit, left) in table.items():
            new[state] = min(new.get(state, (10**9,)), (cost + 4, "D" + audit, left))
        if fault in ("", "truncated"):
            for (state, x), to in follow.items():
                if to in table:
                    cost, audit, left = table[to]
                    cost += 3 * (fault == "truncated")
                    if role[:1] == x:
                        new[state] = min(new.get(state, (10**9,)), (cost, "K" + audit, ((role, text), *left)))
                    if x in name:
                        new[state] = min(new.get(state, (10**9,)), (cost + 3, "R" + audit, ((name[x], text), *left)))
        table = with_inserts(new)
    cost, audit, left = table[""]
    text = "\n".join(f"{a}:{b}" for a, b in left)
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, window=10):
    """docs: (id, text), items: (id, text). Rows (id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows = defaultdict(set)
    for no, text in items:
        w = normal(text)
        for p in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[p:p + window])].add(no)
    out, sizes = [], {len(w) for w in windows}
    for doc, text in docs:
        w, hit, found = normal(text), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                got = windows.get(tuple(w[p:p + k]))
                if got:
                    hit.update(range(p, p + k))
                    found |= got
        ids = sorted({str(x) for x in found if x is not None})
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def collocations(docs, least, share=80, top=2000):
    """docs: (lang, text). Rows (lang, rank, phrase, a, l, r, n, score)."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                counts[lang].update(tuple(w[p:p + k]) for p in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, _, lf, rf = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), lf, rf))
        for rank, (s, a, p, lf, rf) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lf, rf, n[lang], -s))
    return out

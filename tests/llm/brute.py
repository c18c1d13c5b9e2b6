"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that carry names the operators use inside.
CLASHING = "doc_id long, text string, id long, row long, n long, key string, words int, score string, ranges int, text_hash string"
LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
EDGE_TEXTS = [
    None, "", " ", "\n\n", "one", "one two three four five six seven eight nine ten eleven twelve thirteen",
    "one two three four five six seven eight nine ten eleven twelve thirteen", "ünïcode ﬁ 日本語 😀\u0000 tab\tx", LONG, "a" * 20_000,
]


def edge_rows() -> list[tuple]:
    """Null ids, nulls everywhere, repeated rows and every odd text."""
    rows = [(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in enumerate(EDGE_TEXTS)]
    return [*rows, rows[5], rows[8], (None, EDGE_TEXTS[5], None, None, None), (None, None, None, None, None), (20, "one two", None, None, None)]


def clashing(spark):
    return spark.createDataFrame(
        [(1, "some words that stand here for a while and more", 7, 8, 9, "k", 1, "s", 2, "h"), (2, None, None, None, None, None, None, None, None, None)],
        CLASHING)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text: str | None, width: int) -> set:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def near_components(rows: list[tuple], width: int, percent: int = 80) -> dict[int, int]:
    """Index of each row to the index of the first row of its group, in order of (id, index)."""
    sets = [shingles(r[1], width) for r in rows]
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    shared: dict[tuple, int] = defaultdict(int)
    for group in where.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                shared[(a, b)] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in range(len(rows))}


def cut_lines(rows: list[tuple], min_words: int, min_copies: int = 8) -> list[tuple[int, str | None]]:
    """(lines removed, text left) of each row (id, text); ids are unique and ascending."""
    lines = {}
    for k, (_, text) in enumerate(rows):
        raw = [] if text is None else text.split("\n")
        lines[k] = [(j, x, 1 + x.strip(" ").count(" ")) for j, x in enumerate(raw) if x.strip(" ")]
    seen: dict[tuple, tuple] = {}
    runs = []
    for k, doc in lines.items():
        for s in range(len(doc)):
            total = 0
            for e in range(s, len(doc)):
                total += doc[e][2]
                if total >= min_words:  # longer runs that repeat are covered by the shortest ones of their parts
                    runs.append((k, s, e + 1))
                    if total - doc[e][2] >= min_words + 40:
                        break
    places = defaultdict(list)
    for k, doc in lines.items():
        for s, line in enumerate(doc):
            places[line[1]].append((k, s, s + 1))
    often = [p for found in places.values() if len(found) >= min_copies for p in found]
    runs = [*runs, *often]
    for k, s, e in runs:
        seen.setdefault(tuple(x[1] for x in lines[k][s:e]), (k, s))
    gone = defaultdict(set)
    for k, s, e in runs:
        if seen[tuple(x[1] for x in lines[k][s:e])] != (k, s):
            for i in range(s, e):
                last = lines[k][i + 1][0] if i + 1 < len(lines[k]) else len(rows[k][1].split("\n"))
                gone[k].update(range(lines[k][i][0], last))
    return [(len(gone[k]), None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[k]))
            for k, (_, t) in enumerate(rows)]


def overlaps(text: str | None, items: list[tuple], min_words: int = 13, percent: int = 80) -> set:
    """Ids of items that overlap with a text, by all ways they can lie on each other."""
    find = re.compile(r"\w+").findall
    w, found = find((text or "").lower()), set()
    places = defaultdict(list)
    for k, x in enumerate(w):
        places[x].append(k)
    for key, item in items:
        v = find((item or "").lower())
        size = min(min_words, len(v))
        if len(v) < 5:
            continue
        for shift in {p - i for i, x in enumerate(v) for p in places[x]}:
            lo, hi = max(0, shift), min(len(w), shift + len(v))
            same = [w[k] == v[k - shift] for k in range(lo, hi)]
            if any(100 * sum(same[k:k + size]) >= percent * size for k in range(len(same) - size + 1)):
                found.add(key)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(key) -> int:
    return zlib.crc32(str(key).encode()) % 5


def aligned(docs: list[tuple], encode_a, decode_a, encode_b, decode_b) -> list[tuple]:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row (id, text), token by token."""
    done, holders = [], defaultdict(int)
    for key, text in docs:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(map(decode_a, a)) != whole or b"".join(map(decode_b, b)) != whole:
            a, b = [], []
        spans = []
        for ids, decode in ((a, decode_a), (b, decode_b)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(decode(i)), i))
                at = side[-1][1]
            spans.append(side)
        links = [(x, y) for p, q, x in spans[0] for r, s, y in spans[1] if p < s and r < q]
        groups, ends = [], sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        for low, high in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(i) for p, q, i in side if low <= p and q <= high) for side in spans))
        for pair in set(links):
            holders[pair] += 1
        done.append((key, len(a), len(b), len(groups), links, sha(";".join(groups)) if a else ""))
    most: dict[int, int] = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    return [(key, n_a, n_b, n_groups, len(links), sum(holders[x] == most[x[0]] for x in links), sum(holders[x] for x in links), digest)
            for key, n_a, n_b, n_groups, links, digest in done]


def damage(rows: list[tuple]) -> dict:
    """Conversations (turn, role, text) by id after damage, in order; ids of dropped rows keep an empty list."""
    out: dict = {}
    say = lambda x: " " if x is None else x
    for key, turn, role, text in rows:
        turns = out.setdefault(key, [])
        kind = zlib.crc32(f"{say(key)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        turns += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for turns in out.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(turns: list[tuple]) -> list[str]:
    out, seen = [], set()
    for _, role, text in turns:
        ends = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not ends else "duplicate" if (role, text) in seen else "" if ends[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def repaired(turns: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) by a search over all edits, cheapest and least first."""
    import heapq

    found = faults(turns)
    following = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, state, rows = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = [(5, "I", 0, "user", ""), (5, "I", 0, "assistant", "")]
        if at < len(turns):
            _, role, text = turns[at]
            more = 5 if found[at] == "truncated" else 0
            steps.append((2, "D", 1, None, None))
            if found[at] not in ("blank", "duplicate"):
                steps += [(more, "K", 1, role, text), (more + 1, "R", 1, "user", text), (more + 1, "R", 1, "assistant", text)]
        for price, letter, read, role, text in steps:
            if role is None:
                heapq.heappush(heap, (cost + price, audit + letter, at + read, state, rows))
            elif (state, role[:1]) in following:
                heapq.heappush(heap, (cost + price, audit + letter, at + read, following[(state, role[:1])], (*rows, f"{role}:{text}")))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(rows)))


WRAP = (1 << 64) - 1


def mix(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WRAP
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WRAP
    return x ^ (x >> 31)


def fingerprint(text: str | None, width: int = 5, bins: int = 256, bits: int = 4) -> str:
    """One bin after the other: its least shingle hash, or that of the first bin it probes that has one."""
    import xxhash

    w = [xxhash.xxh3_64_intdigest(x) for x in words(text)]
    if not w:
        return ""
    size = min(width, len(w))
    factors = [mix((k + 7 * 0x9E3779B97F4A7C15) & WRAP) | 1 for k in range(1, size + 1)]
    hashes = [mix((size + sum(mix((x + f) & WRAP) * f for x, f in zip(w[i:], factors))) & WRAP) for i in range(len(w) - size + 1)]
    shift = 64 - (bins.bit_length() - 1)
    least: dict[int, int] = {}
    for h in hashes:
        least[h >> shift] = min(h, least.get(h >> shift, h))
    cells = []
    for b in range(bins):
        at, probe = b, 0
        while at not in least:
            at, probe = mix(((b << 32) + probe + 0x51ED) & WRAP) >> shift, probe + 1
        cells.append(mix(least[at]) & ((1 << bits) - 1))
    per = 8 // bits
    return bytes(sum(cells[i + k] << (k * bits) for k in range(per)) for i in range(0, bins, per)).hex()

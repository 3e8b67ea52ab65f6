"""Lexical search, conversation repair and archives against brute force."""

import base64
import functools
import gzip
import hashlib
import io
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import documents, texts

from seekframe.llm import lexical, repair, warc
from seekframe.llm.common import prepared
from seekframe.llm.losertree import LoserTree
from seekframe.session import shared_dir

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- ranked lexical search ----------------------------------------------------


def ranking(rows, items, k):
    docs = [(key, Counter(TERM.findall((text or "").translate(LOWER)))) for key, text in rows]
    n_docs, n_terms = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for key, held in docs:
            score = 0
            for term, times in asked.items():
                if tf := held[term]:
                    m = 25 + (75 * held.total() * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


ITEMS = [
    (1, "ARn, best; coing duo bEst"), (2, None), (3, "nothing-of-that-kind"), (4, "w1 w2 w3 w996 end 日本語 naïve"), (4, "w1 w2 w3 w996 end 日本語 naïve"),
    (None, "no id at all ïstanbul İstanbul"), (6, ""), (7, "arn " * 300 + "eling"), (8, " ".join(f"w{i}" for i in range(900))),
]


def asked(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 0.5, "x") for i, t in items], "item_id long, text string, score double, doc_id string")


@pytest.mark.parametrize("k, terms, tile", [(10, 100_000, 4096), (3, 8, 2)])
def test_ranked_search(spark, monkeypatch, k, terms, tile):
    prepared(spark)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", terms)
    monkeypatch.setattr(lexical, "TILE_TERMS", tile)
    got = [tuple(r) for r in lexical.search(documents(spark), asked(spark), k).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == ranking(texts(), ITEMS, k)


def test_ranked_search_of_nothing(spark):
    prepared(spark)
    assert lexical.search(documents(spark, []), asked(spark)).count() == 0
    assert lexical.search(documents(spark), asked(spark, [])).count() == 0
    assert lexical.search(documents(spark, [(1, None), (2, " .")]), asked(spark)).count() == 0


def test_tiles_stay_exact():
    """Sums within a tile stay below 2^53 and weights too large for one tile are cut; nothing is lost."""
    rng = random.Random(3)
    entries = sorted((t, i, rng.choice([1, 40_000, 10**11])) for t in range(40) for i in range(3))
    column, row, own = (np.array(x) for x in zip(*entries))
    tiles = lexical.vocabulary_tiles(row, column, own, 3)
    total = Counter()
    for rows, columns, weights in tiles:
        sums = Counter()
        for r, c, w in zip(rows.tolist(), columns.tolist(), weights.tolist()):
            sums[r] += w
            total[c, r] += w
        assert all(s * lexical.IMPACT < lexical.EXACT for s in sums.values())
    assert total == Counter({(t, i): w for t, i, w in entries})


def test_best_keeps_ties():
    best, rng = lexical.Best(2, 4), np.random.default_rng(5)
    scores, ids = rng.integers(0, 4, (2, 300)), rng.permutation(300)
    for at in range(0, 300, 7):
        best.add(scores[:, at : at + 7], ids[at : at + 7])
    for item in range(2):
        want = sorted((-s, d) for s, d in zip(scores[item].tolist(), ids.tolist()) if s > 0)[:4]
        assert [(-s, d) for i, s, d in best.rows.tolist() if i == item] == want


# ---- conversation repair ------------------------------------------------------


def cheapest(rows):
    """Cost and audit over all edits, by the grammar's states."""

    @functools.lru_cache(None)
    def go(i, state, added):
        if i == len(rows):
            end = repair.CLOSING[state]
            return 2 * len(end), end
        role, mark = rows[i]
        letter, after = ("a", repair.USER) if state == repair.ASSISTANT else ("u", repair.ASSISTANT)
        ways = [(3, "D", go(i + 1, state, 0))]
        if mark not in (repair.BLANK, repair.DUPLICATE):
            more = int(mark == repair.CUT)
            if role == "s" and state == repair.START and not added:
                ways.append((more, "K", go(i + 1, repair.OPENED, 0)))
            same = role == letter
            ways.append((more + 2 * (not same), "K" if same else "R", go(i + 1, after, 0)))
        if added < 3:
            ways.append((2, "I", go(i, after, added + 1)))
        return min((c + rest[0], edit + rest[1]) for c, edit, rest in ways)

    return go(0, repair.START, 0)


def test_audits_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        roles = rng.choice([(5, 5, 1, 1), (1, 9, 1, 0), (1, 1, 6, 1), (3, 3, 3, 3)])
        marks = rng.choice([(8, 1, 1, 1), (1, 1, 1, 1), (1, 0, 0, 5)])
        rows = tuple((rng.choices("uasx", roles)[0], rng.choices(range(4), marks)[0]) for _ in range(rng.randint(0, 12)))
        for size in (64, 1, 3):
            blocks = [repair.solved(list(rows[i : i + size])) for i in range(0, len(rows), size)]
            assert repair.joined(blocks) == cheapest(rows), (rows, size)


def repaired_by_hand(rows):
    """A conversation's result from its rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, marked = set(), []
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        mark = 1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0
        seen.add((role, text))
        marked.append((role[:1], mark))
    cost, audit = cheapest(tuple(marked))
    out, left = [], iter(rows)
    for edit in audit:
        row = next(left) if edit != "I" else None
        made = ("user", "assistant")[(len(out) - (1 if out and out[0][0][:1] == "s" else 0)) % 2]
        if edit != "D":
            out.append((row[1], row[2]) if edit == "K" else (made, row[2] if row else ""))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    counts = [sum(m == x for _, m in marked) for x in (1, 2, 3)]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()


def turns_of(seed=4):
    rng, rows = random.Random(seed), []
    said = ["Yes.", "No", "Why?", "", " \t", None, "Ünter ", "a.\n", "x" * 20_000 + "!", "Yes."]
    for conv in [*range(30), None]:
        for turn in range(rng.choice([0, 1, 3, 7, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, rng.choice(said)))
    # One conversation with more than a third of all rows, over many blocks; rows repeated whole.
    rows += [(99, t, rng.choice(["user", "assistant"]), f"{t} words" + rng.choice([".", ""])) for t in range(400)]
    return rows + [rows[3], rows[3], (77, 2**40, "user", "Late."), (77, -5, "assistant", "Early.")]


def conversations(spark, rows):
    given = [(*r, 1, "x", 2) for r in rows]
    return spark.createDataFrame(given, "conv_id long, turn long, role string, text string, place int, kind string, at int").repartition(5)


def test_repaired_conversations(spark):
    prepared(spark)
    rows, want = turns_of(), {}
    for conv, *row in rows:
        want.setdefault(conv, []).append(tuple(row))
    given = conversations(spark, [*rows, (1000, 0, "user", "Gone.")])
    got = {r[0]: tuple(r)[1:] for r in repair.report(given, given.where("conv_id is null or conv_id < 1000")).collect()}
    assert got.pop(1000) == (0, 0, 0, 0, 0, 0, "", repair.NOTHING)
    assert got == {conv: repaired_by_hand(own) for conv, own in want.items()}
    assert repair.report(conversations(spark, []), conversations(spark, [])).count() == 0


def test_damage(spark):
    prepared(spark)
    rows, want = turns_of(), []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in repair.damaged(conversations(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ---- archives -----------------------------------------------------------------


def pages_of():
    rng, rows = random.Random(8), []
    for i in range(120):
        html = rng.choice(["", None, "<p>same</p>", f"<p>{i}</p>", "long " * 30_000, "é\r\n\r\nx"])
        url = rng.choice(["http://www.a.example/x?y=1#z", f"https://b{i % 5}.example:8080/ü {i}", None, "", "no url at all\r\n", f"HTTP://B.Example/{i}", "http://[bad"])
        rows.append((i, url, html))
    return [*rows, rows[2], rows[2], (-(2**63), "http://a.example/", "<p>low</p>"), (2**63 - 1, "http://a.example/", "<p>low</p>"), (None, "http://a.example/", "<p>low</p>"), (None, None, "<p>own</p>"), (None, None, "<p>own</p>")]


def paged(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", False) for r in rows], "page_id long, url string, html string, row int, kind string, revisit boolean").repartition(7)


def expected(rows):
    first = {}
    for page, _, html in rows:
        key = (page is None, page or 0)
        payload = (html or "").encode()
        first[payload] = min(first.get(payload, key), key)
    out, used = [], set()
    for page, _, html in rows:
        payload = (html or "").encode()
        no_id, least = first[payload]
        response = (page is None, page or 0) == (no_id, least) and payload not in used
        used |= {payload} if response else set()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "response" if response else "revisit", None if response or no_id else least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fan, size", [(32, 1_000_000), (2, 9), (3, 30)])
def test_archives(spark, monkeypatch, fan, size):
    prepared(spark)
    monkeypatch.setattr(warc, "ARCHIVE", 3000)
    folder, rows = shared_dir(spark), pages_of()
    runs = warc.write_archives(warc.captures(paged(spark, rows)), folder)
    index = warc.merge_runs(spark, runs, fan, size)
    got = warc.read_archives(index, folder).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["kind"], r["refers_to"]) for r in got), key=repr) == expected(rows)
    for r in got:
        assert (r["payload"] is None) == (r["kind"] == "revisit")
    # The index is in one order over its ranges, and a range is in order within its file.
    entries = [tuple(r) for r in index.select("range", *warc.ORDER).collect()]
    ranges = {}
    for r in entries:
        ranges.setdefault(r[0], []).append(warc._order_key(r[1:]))
    flat = [key for place in sorted(ranges) for key in ranges[place]]
    assert flat == sorted(flat) and len(flat) == len(rows) and (size > 100 or len(ranges) > 2)
    # The archives are plain WARC files: members one after another, each a whole record.
    records = Counter()
    for name in os.listdir(folder.removeprefix("file:")):
        if name.endswith(".gz"):
            raw = gzip.GzipFile(fileobj=io.BytesIO(open(f"{folder.removeprefix('file:')}/{name}", "rb").read())).read()
            while raw:
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                n = int(fields["Content-Length"])
                assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
                records[fields["WARC-Type"]] += 1
                raw = rest[n + 4 :]
    assert records["response"] + records["revisit"] == len(rows) and records["warcinfo"] >= 2


def test_archives_of_nothing(spark):
    prepared(spark)
    folder = shared_dir(spark)
    runs = warc.write_archives(warc.captures(paged(spark, [])), folder)
    assert warc.read_archives(warc.merge_runs(spark, runs), folder).count() == 0


def test_damaged_record_is_refused():
    _, _, raw = warc.record_of(5, "http://a.example/", 3, b"<p>text</p>", b"k", None, False, "s")
    assert warc.parsed(raw)["page_id"] == 5
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(raw.replace(b"text", b"tent"))


def test_record_ids():
    for page in (None, 0, 5, -1, 2**63 - 1, -(2**63)):
        assert warc.page_of(warc.record_id(page, "salt")) == page
    assert warc.record_id(5, "a") != warc.record_id(5, "b")


def test_url_keys():
    assert warc.url_key("http://www.News.example.com:80/a/b?c=d#e") == "com,example,news)/a/b?c=d"
    assert warc.url_key("https://m.example.org:8443") == "org,example,m:8443)/"


def test_loser_tree():
    rng = random.Random(2)
    for k in range(8):
        runs = [sorted((rng.randint(0, 9), i) for i in range(rng.choice([0, 1, 5, 20]))) for _ in range(k)]
        assert list(LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)

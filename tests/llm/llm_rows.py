"""Small tables with the cases every operator must take."""

import random

LONG = " ".join(f"w{i % 997}" for i in range(30_000))


def texts(seed: int = 5, n: int = 40) -> list[tuple]:
    """Random texts, copies, near copies, shared passages, nulls, blanks and a very long one."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ar", "be", "co", "du", "el") for b in ("n", "st", "ing", "o", "t,", "R")]
    shared = [rng.choice(words) for _ in range(80)]
    rows: list[tuple] = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 30, 90, 160]))]
        if i % 4 == 0:
            own = own[:20] + shared + own[20:]
        rows.append((i, " ".join(own)))
    for i, (_, text) in enumerate(rows[:12]):
        near = text.split(" ")
        if i % 2 and len(near) > 5:
            near[3] = "changed"
        rows.append((100 + i, " ".join(near)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, LONG), (204, LONG + " end"), (5, rows[5][1]), (6, rows[6][1])]
    rows += [(205, "İstanbul ẞ \x1c naïve 日本語 \\### <|endoftext|> don't"), (None, "no id at all " * 10)]
    return rows


def documents(spark, rows=None):
    """Documents with further columns whose names the operators use themselves."""
    rows = texts() if rows is None else rows
    kind = "doc_id long, text string, lang string, source string, n_chars long, key string, node int, version int, ids int, length int"
    given = [(k, t, "en" if i % 3 else None, "s0" if i % 2 else None, len(t or ""), "x", 1, 2, 3, 4) for i, (k, t) in enumerate(rows)]
    return spark.createDataFrame(given, kind).repartition(3)

"""Target draw, role repair and address filter against plain versions."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadastre.llm import role_repair, shared, target_draw, url_filter

# ---------------------------------------------------------------- draw

SCHEMA = "doc_id long, text string, key long, n_words string, score string, bucket long, rank long, weight int"


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeé9Z中", k=rng.randint(1, 9))) for _ in range(n))


def plain_features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return found, found + [f"{a} {b}" for a, b in zip(found, found[1:])]


def plain_draw(docs, target, least=20, percent=25):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % 10000

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, plain_features(text)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))

    rows = []
    for key, text in docs:
        found, features = plain_features(text)
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(features), weight, score, None, len(found)])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(fit[:percent * len(fit) // 100]):
        row[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


DOCS = [(1, None), (2, ""), (3, " ., \t"), (4, "ONE"), (5, "x" * 5000 + " " + "é" * 70 + " z"), (6, "don't STOP-it 中文 Ünï"),
        (None, prose(40, 1)), (-7, prose(40, 2)), (8, prose(30_000, 3)), (9, prose(25, 4)), (9, prose(25, 4)), (9, prose(25, 5)),
        *((k, prose(15 + k % 30, k)) for k in range(10, 120)), *((k, prose(30, 1)) for k in range(200, 260))]
TARGET = [None, "", prose(500, 3), prose(60, 77)]


@pytest.mark.parametrize("accuracy", [10_000, 3])
def test_draw_equals_the_plain_one(spark, accuracy):
    docs = spark.createDataFrame([(k, t, 1, "x", "y", 2, 3, 4) for k, t in DOCS], SCHEMA).repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = target_draw.draw(docs, target, accuracy=accuracy)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_draw(DOCS, TARGET)


def test_draw_of_all_of_none_and_without_target(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    everyone = target_draw.draw(docs, none, percent=100)
    assert sorted(map(tuple, everyone.collect()), key=repr) == plain_draw(DOCS, [], percent=100)
    assert target_draw.draw(docs, none, least_words=10 ** 9).where("rank is not null").count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert target_draw.draw(empty, none).count() == 0


def test_draw_of_copies_with_one_key_takes_the_right_number(spark):
    rows = [(5, prose(30, 1))] * 40 + [(6, prose(30, 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([(prose(30, 1),)], "text string")
    ranks = sorted(r["rank"] for r in target_draw.draw(docs, target).collect() if r["rank"])
    assert ranks == list(range(1, 11))


def test_bracket_is_widened_until_it_holds_the_cutoff(spark):
    scores = spark.createDataFrame([(k // 3,) for k in range(1000)], "score long")
    for rows in (1, 10, 500, 999, 1000):
        # the sketch is told to look in the wrong place
        assert target_draw.cutoff(scores, rows, 50, 100) == (1000 - rows) // 3


def test_crc_goes_on_from_what_stands_before():
    runs = [b"a", b"xyz" * 21 + b"z", b"q" * 65, b"w" * 64, b"longer" * 50]
    data = np.frombuffer(b"".join(runs), np.uint8)
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    before = np.array([zlib.crc32(b"word "), 0, 7, zlib.crc32(b"other "), 0], np.uint32)
    assert target_draw.crc_of(data, starts, ends, before).tolist() == [
        zlib.crc32(r, int(b)) for r, b in zip(runs, before)]


# ---------------------------------------------------------------- repair

CONV = "conv_id long, turn long, role string, text string, dropped string, fault string, _seen int, _code int"
LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = re.compile(r"[\x20\x09-\x0D]*")


def plain_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]  # a conversation stays whatever it loses
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        row = (turn, "user" if code == 4 else role, text)
        out[conv] += [row] * {0: 0, 3: 2}.get(code, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def options(row, fault):
    """Cost, letter and output of each edit of a row."""
    yield 2, "D", None
    if fault not in ("blank", "duplicate"):
        extra = 5 if fault == "truncated" else 0
        yield extra, "K", (row[1], row[2])
        for role in ("user", "assistant"):
            yield 1 + extra, "R", (role, row[2])


def result(cost, audit, lines):
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def by_enumeration(rows, faults):
    """Every sequence of edits, with up to two insertions at each place."""
    fill = [(), *(tuple(x) for n in (1, 2) for x in itertools.product(("user", "assistant"), repeat=n))]
    best = None
    for edits in itertools.product(*(list(options(r, f)) for r, f in zip(rows, faults))):
        for places in itertools.product(fill, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for k, place in enumerate(places):
                cost, audit = cost + 5 * len(place), audit + "I" * len(place)
                lines += [(role, "") for role in place]
                if k < len(edits):
                    cost, audit = cost + edits[k][0], audit + edits[k][1]
                    lines += [edits[k][2]] if edits[k][2] else []
            if all(r for r, _ in lines) and LEGAL.fullmatch("".join(r[0] for r, _ in lines)):
                best = min(best or (cost, audit, lines), (cost, audit, lines), key=lambda x: x[:2])
    return result(*best)


def by_last_role(rows, faults):
    """Dynamic programming over the last role, with whole audits and outputs kept."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def put(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def filled(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in after[state]:
                        put(table, role[0], (cost + 5, audit + "I", lines + [(role, "")]))
        return table

    table = filled({"": (0, "", [])})
    for row, fault in zip(rows, faults):
        moved = {}
        for state, (cost, audit, lines) in table.items():
            for more, letter, line in options(row, fault):
                if line is None:
                    put(moved, state, (cost + more, audit + letter, lines))
                elif line[0] and line[0][0] in after[state]:
                    put(moved, line[0][0], (cost + more, audit + letter, lines + [line]))
        table = filled(moved)
    return result(*min((v for k, v in table.items() if k in ("", "a")), key=lambda x: x[:2]))


def plain_repair(rows, solve):
    out = []
    for conv, own in plain_damage(rows).items():
        faults = plain_faults(own)
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        roles = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, *solve(own, faults)))
    return sorted(out, key=repr)


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], CONV).repartition(3)
    return sorted(map(tuple, role_repair.damage_and_mend(df).collect()), key=repr)


TEXTS = ["Yes.", "No!", "and then", "", " \t", None, "What?", "Ünï…", "Yes."]
PARTS = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "upper"]


def conversations(count, rows, seed):
    rng = random.Random(seed)
    return [(None if c == 3 else c, rng.choice([k, k, k, k, None, k + 3, 1]), rng.choice(PARTS), rng.choice(TEXTS))
            for c in range(count) for k in range(rng.randint(1, rows))]


def test_repair_equals_all_sequences_of_edits(spark):
    rows = conversations(60, 2, 5)
    assert repaired(spark, rows) == plain_repair(rows, by_enumeration)


def test_repair_of_longer_conversations(spark):
    rows = conversations(400, 12, 6)
    assert repaired(spark, rows) == plain_repair(rows, by_last_role)
    assert any(not r[7] for r in repaired(spark, rows))  # some conversation lost every row


def test_repair_of_a_very_long_conversation(spark):
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "user", "assistant", "tool"]), f"Line {k}" + rng.choice(".. ")) for k in range(3000)]
    rows += [(2, k, "user", f"Again {k}.") for k in range(2000)]
    assert repaired(spark, rows) == plain_repair(rows, by_last_role)


def test_repair_of_given_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, role_repair.damage_and_mend(table).collect()), key=repr)
    assert got == plain_repair(rows, by_last_role)


def test_repair_of_nothing(spark):
    assert repaired(spark, [(1, 1, "user", "x")])[0][0] == 1
    assert role_repair.damage_and_mend(spark.createDataFrame([], CONV)).count() == 0


def test_rows_without_damage_are_mended_as_they_are(spark):
    df = spark.createDataFrame([(1, False, 1, "user", "Hi."), (1, False, 2, "user", "Well."), (2, True, 1, "user", "Hi.")],
                               "conv_id long, dropped boolean, turn long, role string, text string")
    assert sorted((r["conv_id"], r["cost"], r["audit"]) for r in role_repair.mend(df).collect()) == [(1, 1, "KR"), (2, 0, "")]


# ---------------------------------------------------------------- addresses

PAGES = "page_id long, url string, html string, host long, rule string, path string, _rule string, kind string, n long"


def link(*urls):
    return "<p>" + "".join(f"<a class=x HREF = '{u}'>y</a>" for u in urls)


ROWS = [
    (1, None, None), (2, "no address", link("http://bad.net/es/1")), (3, "", ""), (4, "http://", ""),
    (5, "HTTP://WWW.Example.COM/en/x?q=http://a.net/es/", link("//a.example.org/1", "/local", "mailto:x@y.net")),
    (6, "http://example.com/en/x", None), (7, "http://sub.example.com/en/", None), (8, "http://xexample.com/en/", None),
    (9, "http://example.com", None), (10, "http://example.com?/en/", None), (11, "http://example.com/EN/", None),
    (12, "http://net/es/", None), (13, "http://bad.net/es/1", link("http://worse.org/")), (14, "http://bad.net/fr/1#/es/", None),
    (15, "http://bad.net/en/1", None), (16, "http://half.net/es/1", None), (17, "http://half.net/en/1", None),
    (18, "http://third.net/es/1", None), (19, "http://third.net/en/1", None), (20, "http://third.net/en/2", None),
    (21, "http://farm.org/x", link("https://bad.net/es/9", "https://bad.net/es/9", "https://bad.net/fr/9")),
    (22, "http://farm2.org/x", link("http://farm.org/a", "http://bad.net/")),
    (23, "http://mixed.org/x", link("http://farm.org/", "http://good.com/", "http://unknown.net/es/1")),
    (24, "http://good.com/x", link("http://half.net/", "http://farm.org/")), (24, "http://good.com/x", link("http://half.net/")),
    (None, "http://ünï.org:80/a\nb", None), (25, "http://user@bad.net/fr/", "x" * 100_000 + 'href="' + " " * 50_000),
    *((100 + k, f"http://m{k % 3}.hub.org/{k}", link(*(f"http://h{j}.org/" for j in range(k)), "http://bad.net/es/")) for k in range(30)),
]


def plain_filter(rows, rounds=24):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]

    def rule(host, path):
        fitting = [(v, d, p) for v, d, p in url_filter.RULES
                   if (host == d or host.endswith("." + d)) and path.startswith(p)]
        return max(fitting, key=lambda r: len(r[1] + r[2]), default=None)

    own, named, edges = defaultdict(list), defaultdict(list), Counter()
    for _, url, html in rows:
        host, path = parts(url)
        if not host:
            continue
        own[host].append((rule(host, path) or ("",))[0])
        found = re.findall(r"""href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)""", html or "", re.I)
        for address in dict.fromkeys(found):
            other, start = parts("x://" + address.split("//", 1)[1])
            if other and other != host:
                edges[host, other] += 1
                named[other].append((rule(other, start) or ("",))[0])
    known = {**named, **own}
    scores = {}
    for kind, word in (("trust", "allow"), ("distrust", "block")):
        graph = defaultdict(dict)
        for (a, b), n in edges.items():
            graph[a if kind == "trust" else b][b if kind == "trust" else a] = n
        seed = {h: v.count(word) / len(v) for h, v in known.items()}
        value = dict(seed)
        for _ in range(rounds):
            moved = dict(seed)
            for a, targets in graph.items():
                for b, n in targets.items():
                    moved[b] += 0.85 * value[a] * n / sum(targets.values())
            value = moved
        scores[kind] = value
    out = []
    for page, url, _ in rows:
        host, path = parts(url)
        found = rule(host, path)
        bad = host in known and round(scores["distrust"][host] - scores["trust"][host], 9) >= 0.5
        out.append((page, host, path, found and found[1] + found[2], found[0] if found else "block" if bad else "allow"))
    return sorted(out, key=repr)


def test_filter_equals_the_plain_one(spark):
    shared.work_folder(spark)
    pages = spark.createDataFrame([(*r, 1, "r", "p", "q", "k", 5) for r in ROWS], PAGES).repartition(3)
    got = url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect()), key=repr) == plain_filter(ROWS)


def test_distrust_goes_back_along_links_and_trust_outweighs_it(spark):
    shared.work_folder(spark)
    rows = [(1, "http://bad.net/es/1", link("http://worse.org/")), (2, "http://bad.net/fr/1", None), (3, "http://bad.net/en/1", None),
            (4, "http://farm.org/x", link("http://bad.net/es/9")), (5, "http://worse.org/", None),
            (6, "http://third.net/es/1", None), (7, "http://third.net/en/1", None), (8, "http://third.net/en/2", None),
            (9, "http://named.org/", link("http://other.net/fr/1", "http://good.com/")),
            (10, "http://good.com/", link("http://vouched.net/")), (11, "http://vouched.net/es/", None), (12, "http://vouched.net/en/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    # its own pages; what it links to; being linked to does no harm; a third of its pages is too little
    assert [got[k] for k in (3, 4, 5, 7)] == ["block", "block", "allow", "allow"]
    # an address known from links alone; trust from a trusted host
    assert [got[k] for k in (9, 12)] == ["block", "allow"]


def test_filter_sql_on_the_same_rows(spark, tmp_path):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [list(r) for r in ROWS])
    assert sorted(con.execute(url_filter.oracle_sql()).fetchall(), key=repr) == plain_filter(ROWS)


def test_filter_of_nothing_and_with_other_rules(spark):
    shared.work_folder(spark)
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.b/x/y", None)], "page_id long, url string, html string")
    assert [tuple(r)[3:5] for r in url_filter.judge(pages, rules=[]).collect()] == [(None, "allow")]
    tied = [("allow", "a.b", "/x"), ("block", "b", "/x/y"), ("block", "a.b", "/x"), ("allow", "b", "/x/")]
    assert url_filter.judge(pages, rules=tied).first()["verdict"] == "block"


def test_filter_plan_stays_in_the_jvm(spark):
    shared.work_folder(spark)
    pages = spark.createDataFrame([r for r in ROWS], "page_id long, url string, html string")
    plan = url_filter.judge(pages)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "BroadcastNestedLoop"))

import hashlib
import itertools
import random
import re
import zlib

from ordermill.llm import conversations as cv
from ordermill.llm import oracles
from ordermill.llm.queries import QUERIES
from tests.compare import connect, rows_of, types_of

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, mark int, part int, at string"
WHITE = re.compile(r"[^\x20\x09-\x0D]")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(4)


def faults(rows):
    """The first fault of each (role, text)."""
    found = []
    for i, (role, text) in enumerate(rows):
        body = WHITE.findall(text)
        found.append(
            "blank" if not body else "duplicate" if (role, text) in rows[:i]
            else "truncated" if body[-1] not in ".!?" else "")
    return found


def cheapest(rows, most_inserts=3):
    """(cost, audit, lines) by trying every edit of every row and all inserts."""
    best = None
    inserts = [list(p) for n in range(most_inserts + 1)
               for p in itertools.product([("I", 2, ("user", "")), ("I", 2, ("assistant", ""))], repeat=n)]
    choices = []
    for (role, text), kind in zip(rows, faults(rows)):
        late = kind == "truncated"
        edits = [[("D", 3, None)]]
        if kind not in ("blank", "duplicate"):
            edits += [[("K", late, (role, text))], [("R", 2 + late, ("user", text))],
                      [("R", 2 + late, ("assistant", text))]]
        choices.append(edits)
    slots = [inserts] + [x for edits in choices for x in (edits, inserts)]
    for way in itertools.product(*slots):
        steps = [step for some in way for step in some]
        cost = sum(c for _, c, _ in steps)
        audit = "".join(letter for letter, _, _ in steps)
        if best and (cost, audit) >= best[:2]:
            continue
        lines = [line for _, _, line in steps if line]
        if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in lines)):
            best = (cost, audit, lines)
    return best


def sha(lines):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def expected(rows):
    """What the report says of one conversation's (turn, role, text), by brute force."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    plain = [(role, text) for _, role, text in rows]
    kinds = faults(plain)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(plain, plain[1:])]
    cost, audit, lines = cheapest(plain, 2)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha(lines))


def small_conversations(n, seed=5, most=3):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", "user", "assistant"]
    texts = ["Hi.", "Yes?", "no", " \t", "", "well! \n", "Hi."]
    return {
        conv: [(pick.choice([None, 0, 1, 2, 2, 5, 9]), pick.choice(roles), pick.choice(texts))
               for _ in range(pick.randrange(1, most + 1))]
        for conv in range(n)}


def as_rows(convs):
    return [(conv, *row) for conv, rows in convs.items() for row in rows]


def test_against_all_edits(spark):
    convs = small_conversations(24)
    want = sorted((conv, *expected(rows)) for conv, rows in convs.items())
    for max_rows in (4096, 1, 2):
        report = cv.repair(table(spark, as_rows(convs)), max_rows=max_rows).collect()
        assert sorted(map(tuple, report)) == want


def test_long_conversations_by_parts(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    pick = random.Random(8)
    texts = [f"Line {i}." for i in range(40)] + ["cut", "", "Again."]
    rows = [(i % 3, None if i % 50 == 0 else i // 2, pick.choice(["user", "assistant", "system", "x"]),
             pick.choice(texts)) for i in range(900)]
    rows += [(1, 7, "user", "Same row.")] * 30
    whole = cv.repair(table(spark, rows), max_rows=10_000).collect()
    parts = cv.repair(table(spark, rows), max_rows=7).collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 3
    turns = [cv.repair(table(spark, rows), turns=True, max_rows=n).collect() for n in (10_000, 7)]
    assert sorted(turns[0]) == sorted(turns[1])
    for r in whole:
        lines = [(t.role, t.text) for t in sorted(turns[0], key=lambda t: t.position) if t.conv_id == r.conv_id]
        assert sha(lines) == r.repaired_sha256


def test_whole_table_against_sql(spark):
    db, sql = connect(FOLDER), oracles.ORACLES["op13_conversation_repair"]
    result = QUERIES["op13_conversation_repair"](spark, FOLDER)
    assert dict(result.dtypes) == types_of(db, sql)
    assert rows_of(result.toPandas()) == rows_of(db.execute(sql).fetchdf())


def test_damage(spark):
    rows = [(c, t, r, "One. Two!") for c in range(60) for t, r in ((0, "user"), (None, None))]
    got = cv.damaged(table(spark, rows)).collect()
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role or " ",
               "" if kind == 1 else "One Two" if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_odd_rows_and_conversations_without_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "é" * 50_000 + "?"), (4, None, "user", "Ok."),
            (4, None, "assistant", "Fine.")]
    ids = table(spark, [(i, 0, "user", "x") for i in (None, 4, 9, 9)])
    got = {r.conv_id: tuple(r)[1:] for r in cv.repair(table(spark, rows), ids=ids).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[9] == (0, 0, 0, 0, 0, 0, "", nothing)
    # Without turns the rows go by role: the assistant first.
    assert got[4][:-1] == (0, 0, 0, 0, 0, 4, "IKKI")
    assert got[None][:-1] == (0, 1, 0, 0, 1, 5, "DKI")
    assert len(got) == 3
    assert cv.repair(table(spark, rows).limit(0)).collect() == []


def test_short_audits_compare_as_the_long_ones():
    pick = random.Random(2)
    for _ in range(300):
        stem = "".join(pick.choice("DIKR") for _ in range(3))
        audits = [stem[: pick.randrange(4)] + "".join(pick.choice("IK") for _ in range(pick.randrange(3)))
                  for _ in range(4)]
        short = cv.shortened(audits)
        for a, b in itertools.product(range(4), repeat=2):
            for x, y in itertools.product(["D", "IK", "KKK", "R"], repeat=2):
                assert (audits[a] + x < audits[b] + y) == (short[a] + x < short[b] + y)

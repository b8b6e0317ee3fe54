"""Embedding whitening, source mixing and conversation repair."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
from conftest import SF_SMALL

from casebook.llm import conversations, mixing, whitening
from casebook.llm.queries import QUERIES

# ------------------------------------------------------------------ whitening


def brute_whitening(rows):
    good = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in good)
    good = [(i, tuple(v + [0] * (dim - len(v)))) for i, v in good]
    fit = sorted({v for _, v in good})
    n, sums = len(fit), [sum(v[d] for v in fit) for d in range(dim)]
    cov = np.array([[float(sum((v[i] - Fraction(sums[i], n)) * (v[j] - Fraction(sums[j], n)) for v in fit) / n) for j in range(dim)] for i in range(dim)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    for i, v in good:
        for c in range(min(4, dim)):
            centred = np.array([float(x - Fraction(s, n)) for x, s in zip(v, sums, strict=True)])
            yield i, c + 1, n, sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)), abs(centred @ u[:, c] / np.sqrt(e[c])), e[c] / np.trace(cov)


def test_whitening(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(100, 1), rng.gauss(-3, 9), rng.random(), rng.gauss(0, .1), rng.gauss(1, 4)]) for i in range(150)] + [(9000 + i, [.5, .25, .5, 1., 2.]) for i in range(60)]
    rows += [(1, None), (2, [float("nan"), 1., 1., 1., 1.]), (3, [None, 1., 1., 1., 1.]), (4, [float("inf")]), (5, []), (6, [1.]), (None, [1., 1., 1., 2., 3.]), (7, [2., 0., 0., 0., 0.])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n string")
    got = whitening.whiten(df.repartition(5)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    want = sorted(brute_whitening(rows), key=key)
    got = sorted(got, key=key)
    assert [tuple(r[:4]) for r in got] == [w[:4] for w in want]
    for r, w in zip(got, want, strict=True):
        assert abs(abs(r.whitened) - w[4]) < 1e-9 and abs(r.explained - w[5]) < 1e-9 * w[5] and r.identity_error < 1e-9


def test_covariance_is_exact():
    """Polarised sums of large, nearly equal integers lose nothing."""
    base = 10**15
    fit = [(base + a, base - b) for a, b in ((0, 1), (2, 0), (5, 7), (1, 1))]
    n, sums = len(fit), [sum(v[d] for v in fit) for d in range(2)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    d = [[x - m for x, m in zip(v, centre, strict=True)] for v in fit]
    squares = {(0, 0): sum(a * a for a, _ in d), (1, 1): sum(b * b for _, b in d), (0, 1): sum((a + b) ** 2 for a, b in d)}
    want = [[float(sum((v[i] - Fraction(sums[i], n)) * (v[j] - Fraction(sums[j], n)) for v in fit) / n) for j in range(2)] for i in range(2)]
    assert whitening.covariance(n, sums, centre, squares).tolist() == want


def test_whitening_odd_inputs(spark):
    schema = "vec_id long, embedding array<double>, whitened string"
    frame = lambda rows: spark.createDataFrame([(i, v, "x") for i, v in rows], schema)
    assert whitening.whiten(frame([])).collect() == [] and whitening.whiten(frame([(1, []), (2, None)])).collect() == []
    alike = whitening.whiten(frame([(1, [3., 4.]), (1, [3., 4.])])).collect()  # no variance: no direction
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.identity_error) for r in alike] == [(1, c, 1, 0, None, None) for c in (1, 2)] * 2
    huge = whitening.whiten(frame([(1, [1e300, 2.]), (2, [-1e300, 1.]), (3, [0., 1.5])])).collect()  # as the nearest long
    assert {(r.vec_id, r.deviation) for r in huge if r.component == 1} == {(1, None), (2, None), (3, 1 + 0)} and all(abs(r.identity_error) < 1e-4 for r in huge)


def test_packed_vectors():
    import pyarrow as pa
    vectors = [[0, 0], [], [1, -128], [127, 128], [-(2**63), 2**63 - 1], [2**31, 0, 0], [5, 0, 7]]
    packed = whitening.pack(pa.array(vectors, pa.list_(pa.int64())))
    assert whitening.unpack(packed, 4).tolist() == [v + [0] * (4 - len(v)) for v in vectors]
    assert packed[0] == packed[1]


# ------------------------------------------------------------------ mixing


def brute_targets(rows):
    """source -> (size, target), shared out with exact fractions."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, excess = dict.fromkeys(order, Fraction(0)), set(order), Fraction(sum(size.values()))
    while excess and free:
        share = excess / sum(weight[s] for s in free)
        excess = Fraction(0)
        for s in list(free):
            target[s] += share * weight[s]
            if target[s] > 3 * size[s]:
                excess += target[s] - 3 * size[s]
                target[s] = Fraction(3 * size[s])
                free.discard(s)
    return {s: (size[s], target[s]) for s in order}


def check_mix(rows, got):
    want = brute_targets(rows)
    n_words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((i, s, n_words(t)) for i, t, s in rows), key=str) == sorted(((r.doc_id, r.source, r["size"]) for r in got), key=str)
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        size, target = want[r.source]
        assert r.source_size == size and abs(r.target - target) <= 1e-9 * max(1, target)
        copies = target / size if size else 0
        assert r.taken == r.copies * r["size"] and (r["size"] == 0 or int(copies) <= r.copies <= min(3, int(copies) + 1))
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= largest[s]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_UNITS", 8)  # a deep tree
    monkeypatch.setattr(mixing, "ALIKE_ROWS", 7)
    rng = random.Random(3)
    rows = [(i, "w " * int(rng.lognormvariate(3, 1.2)), rng.choice(["a", "a", "a", "é", "b", "\U0001f600", "Z", None, ""])) for i in range(900)]
    rows += [(77, "same words here", "a")] * 101 + [(None, None, "z"), (None, "", "z"), (None, "one", "tiny"), (None, "x y", "b"), (None, "x y", "b"), (5, "long " * 30000, "b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    check_mix(rows, got)
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    whole = mixing.mixture(df)
    assert whole.columns == df.columns
    want = Counter()
    for r in got:
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in whole.collect()) == +want
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixture(df.limit(0)).collect() == []
    check_mix([(1, None, "a"), (2, " ", None)], mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect())


def test_rounding_keeps_chances_and_sums():
    rng = random.Random(1)
    sizes = sorted((int(rng.lognormvariate(4, 1.4)) + 1 for _ in range(60)), reverse=True)
    for chance in (.07, .5, .8):
        mean, rounds = [0.0] * 60, 3000
        for _ in range(rounds):
            out = mixing.round_group(sizes, [chance] * 60, [rng.getrandbits(63) for _ in sizes], 0)
            assert sum(0 < c < 1 for c in out) <= 1
            assert abs(sum(map(lambda a, b: a * b, sizes, out)) - chance * sum(sizes)) < 1e-6
            mean = [m + c / rounds for m, c in zip(mean, out, strict=True)]
        assert max(abs(m - chance) for m in mean) < .05


def test_mix_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    got = mixing.mix(docs).collect()
    check_mix([tuple(r) for r in docs.collect()], got)


# ------------------------------------------------------------------ conversations

SPACES = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(original, rows):
    """Every state's best (cost, whole audit) from the end on, compared as pairs."""
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        best = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
        following = lambda state: "a" if state == "u" else "u"
        for (_, _, role, _), fault in zip(mine[::-1], faults[::-1], strict=True):
            new = {}
            for state in best:
                options = [(best[state][0] + 3, "D" + best[state][1])]
                if fault not in ("blank", "duplicate"):
                    more, to = fault == "truncated", following(state)
                    options.append((best[to][0] + 2 + more, "R" + best[to][1]))
                    if role[:1] == to or (role[:1] == "s" and state == ""):
                        options.append((best[role[:1]][0] + more, "K" + best[role[:1]][1]))
                new[state] = min(options)
            for _ in range(3):
                new = {state: min(new[state], (new[following(state)][0] + 2, "I" + new[following(state)][1])) for state in new}
            best = new
        cost, audit = best[""] if mine else (0, "")
        out, left, state = [], iter(mine), ""
        for edit in audit:
            if edit == "I":
                state = following(state)
                out.append(f"{ {'u': 'user', 'a': 'assistant'}[state]}:")
                continue
            _, _, role, text = next(left)
            if edit == "R":
                role = {"u": "user", "a": "assistant"}[following(state)]
            if edit != "D":
                state = role[0]
                out.append(f"{role}:{text}")
        assert next(left, None) is None and re.fullmatch("(s?(ua)+)?", "".join(o[0] for o in out))
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
               sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False)), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_repair_of_the_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_conversation_repair"](spark, SF_SMALL).collect()))
    assert got == sorted(brute_repair(rows, brute_damage(rows)))


def test_repair_sql_twin():
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 2]), rng.choice([None, *range(30)]), rng.choice(["user", "assistant", "system", "", "u2", None]), rng.choice(["", "Hi.", "no", ". ", "é!\n", None, *(f"t{i}?" for i in range(90))])) for _ in range(250)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(conversations.SQL).fetchall(), key=str) == sorted(brute_repair(rows, brute_damage(rows)), key=str)


def test_repair_of_odd_rows(spark, monkeypatch):
    """A conversation over all ranges, one of rows alike, null ids, turns, roles, texts."""
    monkeypatch.setattr(conversations, "PIECE_CHARS", 50)
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", "u2", None], ["", "Hi.", "Yes?  ", "no", ". ", "a b.", "a" * 100 + ".", "a" * 100, "é!\n", None, *(f"t{i}." for i in range(500))]
    rows = [(rng.choice([None, 1, 1, 1, 2, 4]), rng.choice([None, None, *range(40)]), rng.choice(roles), rng.choice(texts)) for _ in range(2000)]
    rows += [(1, 5, "user", "same.")] * 1500 + [(3, None, "user", None), (6, 1, "assistant", "x" * 300_000)]
    rows += [(c, t, r, x) for c in range(100, 160) for t, (r, x) in enumerate((rng.choice(roles), rng.choice(texts[:9])) for _ in range(rng.randrange(1, 9)))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, block string")
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, conversations.repair_report(df, conversations.damage(df)).collect()), key=key)
    assert got == sorted(brute_repair(rows, brute_damage(rows)), key=key)
    assert conversations.repair_report(df.limit(0), conversations.damage(df.limit(0))).collect() == []


def test_runs_by_powers():
    """A run's costs by binary powers are those row by row; long runs unroll."""
    for symbol in (0, 1, 4, 5, 8, 9, 12, 2):
        after = conversations.AT_END
        for n in range(1, 40):
            after = conversations._apply(conversations.power(symbol, 0), after)
            assert conversations.before_run(symbol, n, conversations.AT_END) == after
    steps, state = conversations.unroll("\x04" * 10001, conversations.START, conversations.AT_END, True)
    assert len(steps) == 10002 and state == conversations.ASSISTANT

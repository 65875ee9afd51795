import hashlib

import duckdb

from streamledger.llm import preference
from streamledger.llm.queries import LLM_ORACLES, op4_preference_format

SCHEMA = "pair_id long, turn long, role string, text string"


def brute(chosen, rejected):
    sides = [{}, {}]
    for side, rows in zip(sides, (chosen, rejected)):
        for p, t, r, x in rows:
            if p is not None and t is not None:
                side.setdefault(p, {}).setdefault(t, set()).add((r or "", x or ""))
    out = []
    for p in sides[0].keys() & sides[1].keys():
        a, b = sides[0][p], sides[1][p]
        split = min((t for t in a.keys() | b.keys() if a.get(t) != b.get(t)), default=None)
        for part, side in (("prompt", a), ("chosen", a), ("rejected", b)):
            text = ""
            for t in sorted(side):
                if (part == "prompt") == (split is None or t < split):
                    for r, x in sorted(side[t], key=lambda row: hashlib.md5(f"{len(row[0])}:{row[0]}{row[1]}".encode()).hexdigest()[:15]):
                        head, at = f"<|{r}|>\n", len(text)
                        turn = head + x + "<|end|>\n"
                        text += turn
                        learned = part != "prompt" and r == "assistant"
                        span = (at + len(head), len(text)) if learned else (None, None)
                        out.append((p, part, t, r, turn, int(learned), at, len(text), *span))
    return sorted(out, key=lambda row: row[:5])


def ordered(frame):
    return sorted(map(tuple, frame.collect()), key=lambda row: row[:5])


def test_matches_brute_force(spark):
    a = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "good"), (1, 3, "user", "thanks"),
         (2, 0, "user", "q"), (2, 1, "assistant", "same"), (3, 0, "user", "x"), (4, 0, "user", "only chosen"),
         (5, 5, "user", "u"), (5, 9, "assistant", "a"), (5, 9, "assistant", "a"), (6, 0, "user", None), (6, 1, None, "n"),
         (7, 0, "user", "u"), (7, 0, "user", "v"), (7, 1, "assistant", "w"), (None, 0, "user", "u"), (1, None, "user", "u")]
    b = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"), (1, 3, "user", "thanks"),
         (2, 0, "user", "q"), (2, 1, "assistant", "same"), (3, 0, "user", "y"), (5, 5, "user", "u"),
         (6, 0, "user", ""), (6, 1, None, "m"), (7, 0, "user", "u"), (7, 0, "user", "v"), (7, 1, "assistant", "z"), (8, 0, "user", "r")]
    frame = lambda rows: spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", sides int, part string")
    got = preference.format_pairs(frame(a), frame(b))
    assert ordered(got) == brute(a, b)
    prompts = [r for r in got.collect() if r.pair_id == 1 and r.part == "prompt"]
    assert [r.turn for r in sorted(prompts, key=lambda r: r.turn)] == [0, 1]
    assert preference.format_pairs(frame(a).limit(0), frame(b)).collect() == []


def test_long_conversation(spark):
    a = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(3000)]
    b = a[:2500] + [(1, t, "user", "other") for t in range(2500, 2600)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert ordered(preference.format_pairs(frame(a), frame(b))) == brute(a, b)


def test_many_rows_of_one_turn_and_far_numbers(spark):
    far = [-(1 << 62), -5, 0, 3, 1 << 40, (1 << 63) - 1]
    a = [(1, 4, "assistant", f"été 😀 {i}" * (i % 3)) for i in range(400)] + [(1, t, "user", f"t{t}") for t in far]
    b = [(1, 4, "assistant", f"b{i}") for i in range(300)] + [(1, t, "user", f"t{t}") for t in far]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert ordered(preference.format_pairs(frame(a), frame(b))) == brute(a, b)


def test_places_cut_out_what_is_learned(spark):
    a = [(1, 0, "user", "q"), (1, 1, "assistant", "yes"), (1, 2, "user", "and?"), (1, 3, "assistant", "ünd")]
    b = [(1, 0, "user", "q"), (1, 1, "assistant", ""), (1, 2, "tool", "assistant")]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    rows = preference.format_pairs(frame(a), frame(b)).orderBy("part", "turn").collect()
    for part, learned in (("prompt", []), ("chosen", ["yes<|end|>\n", "ünd<|end|>\n"]), ("rejected", ["<|end|>\n"])):
        mine = [r for r in rows if r.part == part]
        text = "".join(r.rendered for r in mine)
        assert [text[r.span_start:r.span_end] for r in mine] == [r.rendered for r in mine]
        assert [text[r.learn_start:r.learn_end] for r in mine if r.loss_mask] == learned
        assert all(r.learn_start is None and r.learn_end is None for r in mine if not r.loss_mask)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{sf}/conversations.parquet')")
    frame = op4_preference_format(spark, sf)
    want = con.execute(LLM_ORACLES["op4_preference_format"])
    assert frame.columns == [c[0] for c in want.description]
    got = ordered(frame)
    assert got == sorted(want.fetchall(), key=lambda row: row[:5])
    assert {"prompt", "chosen", "rejected"} == {r[1] for r in got}

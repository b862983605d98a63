import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.operators import transactions as tx
from tidelog.operators.stitching import FIRST, HEAD, LAST, stitch, stitch_rows
from tidelog.streaming.assembler import cancel

LOG = "pos long, xid string, row_id string, op int, rollback boolean"


def stack(rows):
    """Survivors by simulation of the undo stack."""
    open_, gone, unpaired = {}, set(), set()
    for k, (_, xid, row, _, rb) in enumerate(rows):
        s = open_.setdefault((xid, row), [])
        if not rb:
            s.append(k)
        elif s:
            gone.add(s.pop())
        else:
            unpaired.add(k)
    return {r[0] for k, r in enumerate(rows) if not r[4] and k not in gone}, {rows[k][0] for k in unpaired}


def test_window_form_equals_the_stack(spark):
    rng = random.Random(7)
    rows = [(k, f"x{rng.randrange(6)}", f"r{rng.randrange(3)}", rng.choice((1, 2, 3)), rng.random() < 0.4) for k in range(900)]
    # the rule starts anew where a rollback finds nothing: compare where none does
    kept, unpaired = stack(rows)
    got = tx.cancel_rollbacks(spark.createDataFrame(rows, LOG), ["pos"]).collect()
    clean = {(r[1], r[2]) for r in rows} - {(rows[k][1], rows[k][2]) for k in unpaired}
    assert {r.pos for r in got if r.kept and (r.xid, r.row_id) in clean} == {k for k in kept if (rows[k][1], rows[k][2]) in clean}
    assert {r.pos for r in got if r.unpaired} == unpaired


def test_nested_case(spark):
    ops = [("A", 1, 0), ("B", 1, 0), ("B", 3, 0), ("B", 3, 0), ("B", 3, 1), ("B", 3, 1), ("B", 2, 1), ("A", 2, 1), ("A", 1, 0), ("B", 1, 0)]
    rows = [(k + 1, "x", r, op, bool(rb)) for k, (r, op, rb) in enumerate(ops)]
    assert {r.pos for r in tx.survivors(spark.createDataFrame(rows, LOG), ["pos"]).collect()} == {9, 10}


def test_one_rollback_undoes_the_last_of_three(spark):
    rows = [(k, "x", "A", 3, k == 3) for k in range(4)]
    assert {r.pos for r in tx.survivors(spark.createDataFrame(rows, LOG), ["pos"]).collect()} == {0, 1}


def test_all_undone_gives_no_rows(spark):
    rows = [(0, "x", "A", 1, False), (1, "x", "A", 2, True)]
    assert tx.survivors(spark.createDataFrame(rows, LOG), ["pos"]).count() == 0
    assert tx.suspicious(spark.createDataFrame([(0, "x", "A", 2, True)], LOG), ["pos"]).first().suspicious


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.booleans()), max_size=30))
def test_streaming_cancel_keeps_what_the_stack_keeps(ops):
    rows = [(k, row, 3, rb, 0.0) for k, (row, rb) in enumerate(ops)]
    kept, _ = cancel(rows)
    assert {k[0] for k in kept} == stack([(k, "x", row, 3, rb) for k, (row, rb) in enumerate(ops)])[0]


def record(pos, opcode, fb=0, ufb=0, sfb=0, new=None, old=None, sup=None, **more):
    return {"xid": "x", "pos": pos, "opcode": opcode, "rollback": False, "data_obj": 1, "fb": fb, "ufb": ufb, "sfb": sfb, "sup_op": None, "offset": None, "new": new or {}, "old": old or {}, "sup": sup or {}, "row_id": None, "scn": pos, "rba": str(pos)} | more


ALL = HEAD | FIRST | LAST


def test_single_piece_rows():
    out = list(stitch([record(1, "11.2", fb=ALL, new={1: "a"}), record(2, "11.3", ufb=ALL, old={1: "a"}), record(3, "11.5", fb=FIRST | LAST, ufb=FIRST | LAST, new={1: "b"}, old={1: "a"}, row_id="R")]))
    assert [(r["op"], r["complete"]) for r in out] == [("INSERT", True), ("DELETE", True), ("UPDATE", True)]
    assert out[2]["set"] == {1: "b"} and out[2]["original"] == {1: "a"} and out[2]["row_id"] == "R"


def test_chained_insert_is_one_row():
    out = list(stitch([record(1, "11.2", fb=LAST, new={1: "b"}), record(2, "11.2", fb=HEAD | FIRST, new={1: "a"})]))
    assert len(out) == 1 and out[0]["n_pieces"] == 2 and out[0]["set"] == {1: "a", 2: "b"} and out[0]["complete"]


def test_update_with_tail_and_no_op_tails(spark):
    rows = [record(1, "11.5", fb=0, ufb=0, sfb=FIRST, new={1: "n"}, old={1: "o"}, sup_op="UPDATE"), record(2, "11.16", sfb=LAST, sup={2: "k"}, sup_op="UPDATE")]
    out = list(stitch(rows))
    assert len(out) == 1 and out[0]["where"] == {1: "o", 2: "k"} and out[0]["scn"] == 1
    schema = "xid string, pos long, opcode string, rollback boolean, data_obj long, fb int, ufb int, sfb int, sup_op string, offset int, new map<int,string>, old map<int,string>, sup map<int,string>, row_id string, scn long, rba string"
    got = stitch_rows(spark.createDataFrame(rows, schema)).collect()
    assert [(r.op, r["set"], r.n_pieces) for r in got] == [("UPDATE", {1: "n"}, 2)]


def test_incomplete_row_is_reported():
    out = list(stitch([record(1, "11.2", fb=HEAD | FIRST, new={1: "a"})]))
    assert [r["complete"] for r in out] == [False]

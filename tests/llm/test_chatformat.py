import hashlib
import random

from tideline.llm import chatformat as cf

KIND = "conv_id bigint, turn int, role string, text string"
NASTY = ["\\", "\\\\", "#", "###", "### user: ", "</turn>", "<\\/turn>", "\\#", ": ", "é", "\n", "a", "b", "", "</turn>\n### assistant: x"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 6)))
        assert cf.unescape(cf.escape(t)) == t == cf.unescape(cf.escape_role(t)) == cf.role_of(cf.marked_turns([(t, "x")]))
        assert "</turn>" not in cf.escape(t) and "###" not in cf.escape(t)


def test_round_trip(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 5)))
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", None, word()]), rng.choice([None, word(), word()])) for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(50, None, "user", "second"), (50, -1, "assistant", "third"), (50, None, "assistant", "first"), (50, -1, "assistant", "third"), (None, 1, "user", "x")]
    rows += [(60, k, "assistant", "x" * 1000) for k in range(300)] + [(61, 0, "assistant", "é#" * 100_000), (-7, 5, "user", "own")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND + ", formatted string, spans int")
    convs = {}
    last = 1 << 62
    for c, t, r, x in [*rows, (-7, last, "user", cf.PLANTED), (-7, last + 1, "assistant", cf.PLANTED)]:
        convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    want = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[c] = (len(turns), digest("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), digest(loss), len(cf.marked_turns([x[1:] for x in turns])))
    made = cf.format_chats(cf.with_planted(df))
    assert {r.conv_id: tuple(r)[1:] for r in cf.read_back(made).collect()} == want
    for r in made.collect():
        assert [s.begin for s in r.spans] == [0, *[s.end for s in r.spans][:-1]] and r.spans[-1].end == len(r.formatted) and r.rewrites == []


def templates():
    def forgetful(turns):
        """Drops what earlier assistant turns thought, as some templates do."""
        return "".join(f"[{r}]{x if k == len(turns) - 1 or r != 'assistant' else x.split('|')[-1]}\n" for k, (r, x) in enumerate(turns))

    def counted(turns):
        """Puts the number of turns first."""
        return f"{len(turns)}:" + "".join(x for _, x in turns)

    def upper(turns):
        """What is around a text depends on it."""
        return "".join(f"{len(x)}{x}" if len(x) > 1 else f"<{x}>" for _, x in turns)

    return forgetful, counted, upper  # defined in here, they go to the tasks whole


def test_templates_that_rewrite_history_are_found(spark):
    forgetful, counted, upper = templates()
    turns = [(1, k, r, x) for k, (r, x) in enumerate([("user", "q"), ("assistant", "thought|a"), ("user", "q2"), ("assistant", "b|c")])]
    df = spark.createDataFrame([*turns, (2, 0, "user", "q"), (2, 1, "assistant", "plain"), (2, 2, "user", "x")], KIND)
    got = {r.conv_id: r for r in cf.format_chats(df, forgetful).collect()}
    assert got[1].rewrites == [2] and got[1].spans == [] and got[1].formatted == "[user]q\n[assistant]a\n[user]q2\n[assistant]b|c\n"
    assert got[2].rewrites == [] and [got[2].formatted[s.text_begin : s.text_end] for s in got[2].spans] == ["q", "plain", "x"]
    assert [s.loss for s in got[2].spans] == [False, True, False]
    assert {r.conv_id: r.rewrites for r in cf.format_chats(df, counted).collect()} == {1: [0, 1, 2, 3], 2: [0, 1, 2]}
    assert all(r.spans == [] and r.rewrites == [] for r in cf.format_chats(df.where("conv_id = 1"), upper).collect())


def test_empty(spark):
    none = spark.createDataFrame([], KIND)
    assert cf.format_chats(none).count() == 0
    assert [r.conv_id for r in cf.read_back(cf.format_chats(cf.with_planted(none))).collect()] == [-7]

import random

from oracle import of_duckdb, of_spark

from cairn.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"
A, B, C = "Shall we meet on Monday at noon?", "Noon is fine for me.", "I would rather meet later."


def link(spark, data):
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'x' as path", "'y' as parent_turn", "'z' as c")
    return {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}


def test_nested_levels(spark):
    got = link(spark, [(1, 0, "a", A), (1, 1, "b", f"> {A}\n{B}"), (1, 2, "c", f"Ann wrote:\n> {A}\n{C}"), (1, 3, "a", f">> {A}\n> {B}\nGreat."), (1, 4, "b", "unrelated"), (2, 0, "a", A)])
    assert [got[1, t].parent_turn for t in range(5)] == [None, 0, 0, 1, 3]
    assert [got[1, t].link for t in range(5)] == ["root", "quote", "quote", "quote", "sequence"]
    assert [got[1, t].text for t in range(5)] == [A, B, C, "Great.", "unrelated"]
    assert (got[1, 3].max_level, got[1, 3].n_quoted, got[1, 3].n_linked) == (2, 2, 2)
    assert got[1, 3].path == "0.1.3" and got[1, 2].path == "0.2" and got[2, 0].parent_turn is None


def test_reply_order(spark):
    """Sorted by path, a reply stands below what it quotes."""
    got = link(spark, [(1, 0, "a", A), (1, 1, "b", "something else entirely"), (1, 2, "c", f"> {A}\n{B}"), (1, 3, "d", f"> {B}\n{C}")])
    assert got[1, 3].path.startswith(got[1, 2].path + ".") and got[1, 2].path == "0.2"


def test_normalised_and_unknown_quotes(spark):
    got = link(spark, [(1, 0, "a", A), (1, 5, "b", f">  {A.upper().replace(' ', '   ')}\nyes"), (1, 7, "c", "> never said\nno")])
    assert got[1, 5].parent_turn == 0 and got[1, 7].parent_turn is None and got[1, 7].n_linked == 0


def test_edges(spark):
    data = [(None, 0, "a", None), (None, 1, "b", ""), (3, None, "a", "> x"), (4, 0, "a", A), (4, 0, "a", A), (4, 1, "b", f"> {A}")]
    df = spark.createDataFrame(data, SCHEMA)
    assert quotes.link_quotes(df).count() == len(data)
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_long_chain(spark):
    """Each message quotes the one before: as many rounds as the logarithm, and a full path."""
    n = 40
    got = link(spark, [(1, t, "a", (f"> message number {t - 1}\n" if t else "") + f"message number {t}") for t in range(n)])
    assert got[1, n - 1].path == ".".join(f"{t:02d}" for t in range(n))
    assert sorted(got.values(), key=lambda r: r.path) == [got[1, t] for t in range(n)]


def test_matches_sql(spark, tmp_path):
    """Threads of nested quotes at random, against the SQL."""
    rng = random.Random(2)
    data = []
    for c in range(12):
        texts = []
        for t in range(rng.randrange(1, 14)):
            own = "\n".join(f"say {rng.randrange(9)} in {c % 4} words {rng.randrange(30)}" for _ in range(rng.randrange(1, 4)))
            if texts and rng.random() < 0.7:
                quoted = "\n".join(("> " if not x.startswith(">") else ">") + x for x in rng.choice(texts).split("\n"))
                own = rng.choice(["", "On Monday Ann wrote:\n", "Bob schrieb: \n"]) + quoted + rng.choice(["\n", "\n\n"]) + rng.choice([own, own.upper()])
            texts.append(own)
            if rng.random() < 0.9:
                data.append((c, t, "user", own))
    df = spark.createDataFrame(data, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    next((tmp_path / "c").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    columns, rows = of_spark(quotes.link_quotes(df))
    assert (columns, rows) == of_duckdb(quotes.ORACLE_SQL, str(tmp_path))
    assert sum(r[columns.index("link")] == "quote" for r in rows) > 20


def test_very_long_runs_of_marks(spark):
    """Java's pattern engine must not call itself once a mark."""
    messages = [(1, 0, "u", "a line"), (1, 1, "v", ">" * 100_000 + " a line\n" + "> " * 50_000), (1, 2, "w", "> > a line\nno")]
    got = {r.turn: r for r in quotes.link_quotes(spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].max_level == 100_000 and got[1].parent_turn == 0 and got[2].max_level == 2 and got[2].text == "no"


def test_passages_are_found_however_their_lines_are_broken(spark):
    first = "We could meet on Monday\nat noon in the old hall,\nif that is fine for you.\n\nThanks"
    again = "> We could meet on Monday at noon\n> in the old hall, if that\n> is fine for you.\nYes.\nThanks"
    other = "Thanks\nfor nothing"
    got = link(spark, [(1, 0, "a", other), (1, 1, "b", first), (1, 2, "c", again), (1, 3, "d", "> Thanks\n\nok"), (1, 4, "e", ">> We could meet on Monday at noon in\n>> the old hall, if that is fine for you.\n> Yes.\n> Thanks\nfine")])
    assert got[1, 2].parent_turn == 1 and got[1, 2].n_linked == 3
    # the passage "Thanks" is first whole in message 1; as a line it stands in message 0 already
    assert got[1, 3].parent_turn == 0
    assert got[1, 4].parent_turn == 2 and got[1, 4].n_linked == 4 and got[1, 4].max_level == 2

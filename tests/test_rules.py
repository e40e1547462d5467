from pyspark.sql import functions as F

from tidemark.plans.rules import Word, group_of, parse

TEXT = """
# a comment
[GLOBAL_FILTER]
advert

[WORD_GROUPS]
+rocket
launch
!toy
@3

/ai|ml/ => Machines
[Weather]
rain
"""


def test_grammar():
    r = parse(TEXT)
    assert r.filters == ["advert"] and r.excluded == [Word("toy")]
    assert [(g.name, g.most) for g in r.groups] == [("rocket launch", 3), ("Weather", 0)]
    assert r.groups[1].normal == [Word("ai|ml", True), Word("rain")]


def test_first_match_wins_and_filters_come_first(spark):
    r = parse(TEXT)
    rows = [("Rocket launch in rain",), ("rocket only",), ("Rain",), ("rain advert",), ("toy rocket launch",), ("  ",), (None,)]
    got = [x[0] for x in spark.createDataFrame(rows, "title string").select(group_of(r, F.col("title"))).collect()]
    assert got == ["rocket launch", None, "Weather", None, None, None, None]


def test_automaton_is_the_case_expression(spark):
    """A rule set of thousands of words, in one part and in many, against one CASE over a sample of its groups and a loop over all."""
    import random

    from tidemark.operators.rule_match import positions

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé日") for _ in range(rng.choice([1, 2, 2, 3, 4])))
    groups = [(k, [word() for _ in range(rng.choice([0, 1, 1, 2]))], [word() for _ in range(rng.choice([0, 1, 3]))]) for k in range(2000)]
    groups = [g for g in groups if g[1] or g[2]]
    rejecting = [word() + "x" for _ in range(60)]
    titles = [" ".join(word() + rng.choice(["", "", "x"]) for _ in range(rng.randrange(1, 6))) for _ in range(300)] + ["", "  ", None, "ABCDE É", "zzz"]

    def expected(title, groups):
        low = (title or "").lower()
        if not low.strip() or any(w in low for w in rejecting):
            return None
        return next((k for k, required, normal in groups if all(w in low for w in required) and (not normal or any(w in low for w in normal))), None)

    rules = [(k, role, w) for k, required, normal in groups for role, words in (("required", required), ("normal", normal)) for w in words] + [(None, "excluded", w) for w in rejecting]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, title string")
    for most in (1 << 24, 4000):
        got = {r.i: r.position for r in positions(df, spark.createDataFrame(rules, "position int, role string, word string"), "title", most=most).collect()}
        assert got == {i: expected(t, groups) for i, t in enumerate(titles)}
    few = groups[::40]
    from tidemark.plans.rules import Group, Rules

    case = Rules([Group(str(k), [Word(w) for w in required], [Word(w) for w in normal]) for k, required, normal in few], [Word(w) for w in rejecting])
    by_case = {r[0]: r[1] for r in df.select("i", group_of(case, F.col("title"))).collect()}
    own = spark.createDataFrame([r for r in rules if r[0] is None or r[0] in {k for k, *_ in few}], "position int, role string, word string")
    assert {r.i: None if r.position is None else str(r.position) for r in positions(df, own, "title").collect()} == by_case


def test_no_rules(spark):
    from tidemark.operators.rule_match import positions

    df = spark.createDataFrame([(1, "a")], "i int, title string")
    assert positions(df, spark.createDataFrame([], "position int, role string, word string"), "title").first().position is None

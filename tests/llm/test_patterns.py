from llm_fixtures import words
from gridmetrics.llm import pii


def found(spark, rows):
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r["doc_id"] for r in out if "found:" in r["spans"]}


def test_one_trusted_word_finds_identifiers(spark):
    """A trusted label before varying words, at the end of a text; a trusted word after one at its beginning."""
    rows = [(i, f"{words(4, i)} contact: user{i}@mail.example {words(4, i + 900)}") for i in range(60)]
    rows += [(100, "contact: ab-4417-x"), (101, f"{words(3, 7)} contact: ab-5518-y {words(3, 8)}")]
    rows += [(200 + i, f"{words(4, i + 50)} user{i}@post.example replied {words(4, i + 950)}") for i in range(60)]
    rows += [(300, "cd-7731-z replied"), (301, f"{words(4, 99)} chapter 10-20-30")]
    assert found(spark, rows) == {100, 101, 300}


def test_rounds_go_on_until_nothing_is_added(spark):
    """Each link of the chain is found by words that the one before made trusted."""
    rows = []
    for step in range(7):
        values = [f"user{i}@mail.example" for i in range(6)] + [f"id-{k}-1234" for k in (step, step + 1) if k]
        for side in ("alpha", "beta"):
            rows += [(len(rows) + k, f"{side}{'abcdefg'[step]} {v} {words(1, 5000 + 8 * len(rows) + k)}xyz") for k, v in enumerate(values)]
    got = found(spark, rows)
    assert got == {d for d, t in rows if " id-" in t}

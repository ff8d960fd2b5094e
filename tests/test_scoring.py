import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.messages import WORDS
from plain_rule import brute_score, clean
from murmura.operators import scoring
from murmura.operators.lexicon import MODIFIERS, NEGATORS, TERMS, load_lexicon
from murmura.operators.scoring import (
    analyze_text,
    batch_analyze,
    prepare_lexicon,
    score_sentiment,
)
from murmura.schemas import LEXICON


# Acceptance sentences and their labels.
EXAMPLES = [
    ("I love this amazing product! It's fantastic!", "positive"),
    ("This is terrible! I hate it so much!", "negative"),
    ("This is a regular statement about something.", "neutral"),
]


def test_example_labels(spark):
    df = spark.createDataFrame(EXAMPLES, "text STRING, want STRING")
    rows = score_sentiment(df).collect()
    assert [r.sentiment_label for r in rows] == [r.want for r in rows]
    assert rows[0].polarity > 0 > rows[1].polarity
    assert abs(rows[2].polarity) < 0.2
    assert all(r.confidence == abs(r.polarity) for r in rows)


def test_batch_keeps_rows_order_and_columns(spark):
    # The acceptance batch.
    texts = ["I love this!", "This is awful!", "This is okay."]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    rows = batch_analyze(df).collect()
    assert [r.text for r in rows] == texts
    assert [r.sentiment_label for r in rows] == ["positive", "negative", "neutral"]
    assert batch_analyze(df).columns == [
        "text", "cleaned_text", "polarity", "subjectivity", "sentiment_label", "confidence"
    ]


def test_missing_text_scores_neutral(spark):
    row = analyze_text(spark, None).first()
    assert (row.polarity, row.subjectivity, row.sentiment_label, row.confidence) == (
        0.0, 0.0, "neutral", 0.0
    )
    assert row.cleaned_text is None


def words(spark, rows=WORDS):
    return spark.createDataFrame(rows, LEXICON)


RULE_CASES = [
    ("thing", 0.6), ("the thing", 0.9), ("the thing!", 1.0), ("from thing", -0.3),
    ("from the thing", -0.45), ("from a thing", 0.6), ("thing !", 0.75), ("thing then", 0.45),
    ("only stupid", -1.0), ("from only stupid!", 0.5), ("THING", 0.6), ("things", 0.0),
    ("thing http://thing.com", 0.6), ("@thing #thing", 0.0), ("thing's", 0.0),
]


def test_rule(spark):
    df = spark.createDataFrame(RULE_CASES, "text STRING, want DOUBLE")
    for r in score_sentiment(df, words(spark)).collect():
        assert r.polarity == pytest.approx(r.want), r.text


def random_texts(n, seed):
    pool = [w for w, *_ in WORDS] + ["a", "zebra", "!", "!!", "@the", "#from", "www.x", "don't", " "]
    rng = random.Random(seed)
    return [" ".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(n)] + [None, "", "!"]


@pytest.mark.parametrize("joined", [False, True], ids=["inline", "joined"])
def test_matches_brute_force(spark, joined):
    texts = random_texts(300, 1)
    # Half of all rows are copies of one text, some of them alike in every column.
    texts += ["from the thing then only trash !"] * 300
    df = spark.createDataFrame([(i % 450, t) for i, t in enumerate(texts)], "id INT, text STRING")
    rows = score_sentiment(df, words(spark), joined=joined).collect()
    assert len(rows) == len(texts)
    for r in rows:
        p, s = brute_score(r.text, WORDS)
        assert r.polarity == pytest.approx(p, abs=1e-12)
        assert r.subjectivity == pytest.approx(s, abs=1e-12)
        assert -1 <= r.polarity <= 1 and 0 <= r.subjectivity <= 1


def test_joined_with_text_as_the_only_column(spark):
    texts = random_texts(50, 2) + ["thing"] * 50
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    rows = score_sentiment(df, words(spark), joined=True).collect()
    assert sorted((r.text or "", round(r.polarity, 9)) for r in rows) == sorted(
        (t or "", round(brute_score(t, WORDS)[0], 9)) for t in texts
    )


def test_large_list_asks_for_the_join(spark, monkeypatch, folder):
    rows = WORDS + [(f"filler{i}", "term", 0.1, 0.1, None) for i in range(200)]
    monkeypatch.setattr(scoring, "INLINE_ROWS", 100)
    with pytest.raises(ValueError, match="joined=True"):
        prepare_lexicon(spark, words(spark, rows))
    ready = prepare_lexicon(spark, words(spark, rows), joined=True)
    df = spark.createDataFrame([("the thing",)], "text STRING")
    assert score_sentiment(df, ready).first().polarity == pytest.approx(0.9)
    df.write.parquet(f"{folder}/t")
    with pytest.raises(ValueError, match="stream"):
        score_sentiment(spark.readStream.schema("text STRING").parquet(f"{folder}/t"), ready)


def test_both_plans_agree_to_the_last_bit(spark):
    rows = [("good", "term", 0.3, 0.5, None), ("fine", "term", 0.1, 0.2, None), ("bad", "term", -0.1, 0.7, None),
            ("kinda", "modifier", None, None, 0.0)]
    texts = ["good fine bad", "bad good fine", "fine bad good", "good bad", "kinda good", "kinda bad fine good!", "don\u2019t good"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING").repartition(4)
    columns = ["id", "polarity", "subjectivity", "sentiment_label"]
    both = [score_sentiment(df, words(spark, rows), joined=j).select(columns).orderBy("id").collect() for j in (False, True)]
    assert both[0] == both[1]
    assert {r.sentiment_label for r in both[0] if texts[r.id] == "kinda good"} == {"neutral"}


def test_typographic_apostrophe_is_an_apostrophe(spark):
    rows = [("don't", "negator", None, None, None), ("like", "term", 0.5, 0.5, None)]
    for text in ("don't like", "don\u2019t like", "I DON\u2019T like"):
        assert analyze_text(spark, text, words(spark, rows)).first().polarity == pytest.approx(-0.25)


def test_large_inline_list_finds_every_word(spark):
    many = [(f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "term", i / 3000, 0.5, None)
            for i in range(3000)]
    df = spark.createDataFrame([(w, p) for w, _, p, _, _ in many], "text STRING, want DOUBLE")
    wrong = score_sentiment(df, words(spark, many)).where("abs(polarity - want) > 1e-12")
    assert wrong.count() == 0


def test_senses_are_averaged_and_case_is_ignored(spark):
    rows = [("Good", "term", 0.4, 0.2, None), ("good", "term", 0.8, 0.4, None)]
    row = analyze_text(spark, "good", words(spark, rows)).first()
    assert (row.polarity, row.subjectivity) == (pytest.approx(0.6), pytest.approx(0.3))


def test_term_that_is_also_a_modifier(spark):
    rows = [("pretty", "term", 0.5, 0.5, None), ("pretty", "modifier", None, None, 0.5),
            ("bad", "term", -0.6, 0.6, None)]
    for joined in (False, True):
        df = spark.createDataFrame([("pretty bad",)], "text STRING")
        row = score_sentiment(df, words(spark, rows), joined=joined).first()
        assert row.polarity == pytest.approx((0.5 - 0.3) / 2)


def test_lexicon_from_file(spark, folder):
    words(spark).write.csv(f"{folder}/words", header=True)
    loaded = load_lexicon(spark, f"{folder}/words", "csv", header="true")
    assert analyze_text(spark, "the thing", loaded).first().polarity == pytest.approx(0.9)


def test_threshold_is_a_parameter(spark):
    df = spark.createDataFrame([("then",)], "text STRING")
    assert score_sentiment(df, words(spark)).first().sentiment_label == "positive"
    assert score_sentiment(df, words(spark), threshold=0.3).first().sentiment_label == "neutral"


def test_own_scorer(spark):
    @F.pandas_udf("polarity DOUBLE, subjectivity DOUBLE")
    def by_length(text: pd.Series) -> pd.DataFrame:
        n = text.str.len()
        return pd.DataFrame({"polarity": n / 100, "subjectivity": n * 0.0})

    df = spark.createDataFrame([("x" * 50 + " @gone",), ("x",), (None,)], "text STRING")
    rows = score_sentiment(df, scorer=by_length, keep_cleaned=True).collect()
    assert [r.polarity for r in rows] == [0.5, 0.01, 0.0]
    assert [r.sentiment_label for r in rows] == ["positive", "neutral", "neutral"]
    assert rows[0].cleaned_text == clean("x" * 50 + " @gone")


def test_default_list_is_well_formed():
    assert all(-1 <= p <= 1 and 0 <= s <= 1 for p, s in TERMS.values())
    names = list(TERMS) + list(MODIFIERS) + NEGATORS
    assert all(n == n.lower() and " " not in n for n in names)

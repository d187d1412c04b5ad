import random

from hyetos.functions.conditions import GLYPHS, RULES, with_condition_class


def classify(text):
    """The rule in plain words: exact pattern, else first contained pattern, else other."""
    if not text:
        return "unknown"
    for pattern, name in RULES:
        if text == pattern:
            return name
    for pattern, name in RULES:
        if pattern.lower() in text.lower():
            return name
    return "other"


def test_rules_and_glyphs():
    assert len(RULES) == 39 and len({p for p, _ in RULES}) == 39
    assert {name for _, name in RULES} | {"unknown", "other"} == set(GLYPHS)


def test_every_branch(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "hail", "partly CLOUDY", "Partly cloudy skies", "Mostly Sunny and Mist"]
    texts += [p for p, _ in RULES] + [p.upper() for p, _ in RULES] + [f"so {p} it is" for p, _ in RULES]
    texts += [f"{rng.choice(RULES)[0]} then {rng.choice(RULES)[0].lower()}" for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = with_condition_class(frame, "text").orderBy("id").collect()
    assert [r.condition_class for r in found] == [classify(t) for t in texts]
    assert all(r.condition_glyph == GLYPHS[r.condition_class] for r in found)


def test_priorities(spark):
    cases = {
        "Patchy light rain with thunder": "thunder",
        "patchy light rain with thunder": "rain",
        "Freezing fog": "freezing_fog",
        "freezing fog": "fog",
        "Moderate or heavy rain in area with thunder": "rain",
    }
    frame = spark.createDataFrame([(t,) for t in cases], "text string")
    assert {r.text: r.condition_class for r in with_condition_class(frame, "text").collect()} == cases


def test_own_rules_with_quotes(spark):
    rules = [("it's \\\\ hot", "clear"), ("cold", "snow")]
    frame = spark.createDataFrame([("it's \\\\ hot",), ("so IT'S \\\\ HOT",), ("Cold one",)], "text string")
    found = [r.condition_class for r in with_condition_class(frame, "text", rules).collect()]
    assert found == ["clear", "clear", "snow"]

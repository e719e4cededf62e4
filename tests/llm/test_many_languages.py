"""Languages beyond the hundred commonest, and those of rows without ids."""

import random

from pyspark.sql import functions as F

from twinfold.llm import language

DDL = "doc_id long, text string, lang string"


def texts(lang, n):
    draw = random.Random(lang)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
    return [" ".join(draw.choices(words, k=30)) for _ in range(n)]


def test_every_language_is_learned(spark):
    rows, asked = [], []
    for k in range(130):
        lang = f"l{k:03}"
        *given, other = texts(lang, 4 if k < 110 else 3)  # the last are the rarest
        rows += [(None if k % 10 == 9 else 100 * k + j, t, lang) for j, t in enumerate(given)]
        asked.append((k, other, lang))
    model = language.learned(spark.createDataFrame(rows, DDL), F.lit(False))
    assert model.languages == sorted({lang for _, _, lang in rows})
    found = language.identify(spark.createDataFrame(asked, DDL), model).collect()
    right = [r["lang_pred"] == f"l{r['doc_id']:03}" for r in found]
    assert len(right) == 130 and sum(right) >= 125


def test_a_common_language_does_not_push_out_others(spark):
    same = [(None, t, "common") for t in texts("common", 1)] * 500
    rows = [(None, t, "many") for t in texts("many", 900)]
    rows += [(None, t, "rare") for t in texts("rare", 1)]
    picked = language.sample(spark.createDataFrame(same + rows, DDL), per_language=5)
    assert {lang for _, lang in picked} == {"common", "many", "rare"}
    assert len(picked) <= 3 * 11 and len(set(picked)) == len(picked)


def test_all_letters_of_a_long_run_count():
    one, two = ("".join(texts(x, 1)[0].split()) for x in ("one", "two"))
    model = language.fit([(t, x) for x in ("one", "two") for t in texts(x, 20)])
    run = one[:80] + two * 5
    assert "".join(language.words_of(run)) == run
    share = dict(zip(model.languages, model.labeller().shares([run])[0]))
    assert share["two"] > 0.8 and share["one"] > 0.02

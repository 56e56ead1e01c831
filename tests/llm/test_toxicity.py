import random

import numpy as np
from corpus import corpus, empty, odd

from orderlake.llm import toxicity
from orderlake.llm.toxicity import Machine, features, fit, pierced, score, symbols, train

CLEAN = "river stone garden window music letter summer basket silver market candle mirror".split()
INSULTS = "idiot moron stupid pathetic worthless".split()


def text(rng, insults):
    sentences = [" ".join(rng.choice(CLEAN) for _ in range(9)) for _ in range(4)]
    for word in insults:
        k = rng.randrange(4)
        sentences[k] += f" you {word}"
    return ". ".join(sentences)


def codes(s):
    return np.array(list(map(ord, s.lower())), np.uint32)


def taught(n=400, seed=1):
    rng = random.Random(seed)
    texts = [text(rng, rng.sample(INSULTS, 2) if i % 4 == 0 else ()) for i in range(n)]
    return texts, np.array([i % 4 == 0 for i in range(n)])


def test_symbols_join_what_is_spaced_or_pierced():
    plain = symbols(codes("you idiot")).tolist()
    for other in ("You i.d.i.o.t", "you id-iot", "you  i d i o t!"):
        assert symbols(codes(other)).tolist() == plain


def test_features_are_gapped_subsequences():
    stream = symbols(codes("abcde"))
    found, weights = features(stream)
    seen = {}
    padded = stream.tolist()
    for i in range(len(padded)):
        for c in range(3, toxicity.REACH):
            for b in range(2, c):
                for a in range(1, b):
                    if i + c < len(padded) and padded[i + c]:
                        code = sum(padded[i + o] << 5 * k for k, o in enumerate((0, a, b, c)))
                        seen[code] = seen.get(code, 0) + toxicity.DECAY ** (c + 1)
    assert found.tolist() == sorted(seen)
    assert np.allclose(weights, [seen[c] for c in sorted(seen)])


def test_table_of_weights_is_the_machine():
    """The sum over a window's subsequences is the decision in the mapped space."""
    texts, toxic = taught()
    streams = [symbols(codes(t)) for t in texts]
    mapped = toxicity.Map.of(toxicity.landmarks(streams, toxic))
    w = np.random.default_rng(1).normal(size=mapped.phi.shape[1])
    machine = Machine(mapped.table(w), 0.5, np.zeros(6))
    stream = streams[0]
    direct = mapped.windows(stream, toxicity.window_starts(stream)) @ w + 0.5
    assert np.allclose(machine.windows(stream), direct, atol=1e-3)


def test_insults_are_found_also_with_inserted_characters():
    texts, toxic = taught()
    machine = train([codes(t) for t in texts], toxic)
    rng = random.Random(2)
    clean = [machine.score(codes(text(rng, ()))) for _ in range(60)]
    assert max(clean) < 0.5
    for forms in (INSULTS, ["i d i o t", "m.o.r.o.n"], ["id-iot", "stu_pid"], ["idixot", "pathxetic"]):
        found = [machine.score(codes(text(rng, rng.sample(forms, 2)))) for _ in range(30)]
        assert np.mean(np.array(found) >= 0.5) > 0.9, forms


def test_held_out_accuracy_and_labels_of_held_out_rows(spark):
    texts, toxic = taught(300)
    df = corpus(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in score(df, labels).collect()}
    held = [i for i, r in found.items() if r.held_out]
    assert np.mean([found[i].predicted == toxic[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    turned = spark.createDataFrame(
        [(i, int(t) ^ int(i in held)) for i, t in enumerate(toxic)], "doc_id long, toxic int"
    )
    assert {r.doc_id: r.score for r in score(df, turned).collect()} == {
        i: r.score for i, r in found.items()
    }


def test_odd_rows(spark):
    df = odd(spark)
    labels = spark.createDataFrame(
        [(4, 1), (4, 0), (5, None), (None, 1), (8, 0), (99, 1)], "doc_id long, toxic int"
    )
    found = score(df, labels).collect()
    assert len(found) == df.count()
    empties = {r.score for r in found if r.doc_id in (1, 2, 3)}
    assert len(empties) == 1


def test_no_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert score(empty(spark), none).collect() == []
    assert len({r.score for r in score(odd(spark), none).collect()}) == 1
    assert fit(empty(spark), none).bias == -1.0


def test_pierced_forms():
    word = np.array([1, 2, 3, 4], np.uint8)
    forms = [f.tolist() for f in pierced(word, np.random.default_rng(0))]
    assert [len(f) for f in forms] == [5, 5, 5, 7, 7, 7]
    for k, form in enumerate(forms[:3]):
        assert form[: k + 1] + form[k + 2 :] == word.tolist()
    assert all(form[::2] == word.tolist() for form in forms[3:])


def test_a_letter_inserted_into_insults_of_the_driver(spark):
    """Found nine times in ten where the plain form is, and clean texts are left alone."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    machine = fit(docs, labels)
    clean = docs.join(labels.where("toxic = 0 and quality = 1"), "doc_id").where("length(text) between 100 and 5000")
    texts = [r.text for r in clean.orderBy("doc_id").limit(40).collect()]
    rng = np.random.default_rng(3)
    words = "idiot clown stupid worthless moron loser pathetic trash scum".split()

    def found(form):
        scores = []
        for text in texts:
            insults = " ".join(f"you {form(w)}." for w in rng.choice(words, 4))
            scores.append(machine.score(np.frombuffer(f"{text} {insults}".lower().encode("utf-32-le"), np.uint32)))
        return sum(s >= 0.5 for s in scores)

    def inserted(word):
        k = rng.integers(1, len(word))
        return word[:k] + chr(97 + rng.integers(26)) + word[k:]

    plain = found(str)
    assert plain >= 36 and found(inserted) >= 0.9 * plain and found(".".join) >= 0.9 * plain
    flagged = [machine.score(np.frombuffer(t.lower().encode("utf-32-le"), np.uint32)) >= 0.5 for t in texts]
    assert sum(flagged) <= 2

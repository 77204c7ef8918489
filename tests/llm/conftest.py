import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents as rows of (doc_id, text, lang, source); n_chars follows. With ``more``,
    columns whose names the operators use themselves."""

    def make(rows, more=False):
        full = [(*r, *[None, "s", "en"][len(r) :]) if len(r) < 4 else r for r in (tuple(r) for r in rows)]
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s") for r in full]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        full = [(*r, len(r[1]) if r[1] is not None else None) for r in full]
        if more:
            schema += ", node string, size string, word string, n string, shards string, copies string"
            schema += ", kept string, class_id string, row string, id string, src string, bucket string"
            schema += ", key string, near_row_key string, text_key string"
            full = [(*r, *"abcdefghijklmno") for r in full]
        return spark.createDataFrame(full, schema)

    return make


SENTENCES = [
    "The old mill by the river ground corn for seven villages until the flood of spring.",
    "Nobody in the harbour town remembered who had first painted the lighthouse in red.",
    "A narrow road climbs from the valley floor to the pass and is closed in winter.",
    "She kept the letters in a tin box under the stairs and never read them again.",
    "Every second summer the orchestra plays outdoors if the weather allows it at all.",
    "Two engineers measured the bridge twice and found it shorter than the plans said.",
]


@pytest.fixture(scope="session")
def prose():
    """Distinct plain texts of several lines: prose(i)."""
    import random

    def make(i: int, lines: int = 4) -> str:
        dice = random.Random(i)
        out = []
        for _ in range(lines):
            words = " ".join(dice.sample(SENTENCES, 2)).split()
            dice.shuffle(words)
            out.append(" ".join(words[:14]).capitalize() + f" {i}.")
        return "\n".join(out)

    return make

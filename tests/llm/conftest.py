import pytest

from sievewright.llm.shipping import ship
from sievewright.storage import Workspace

#: Null, empty, blank and long texts, ties, repeated rows, shared and null ids, invalid-looking characters.
PASSAGE = " ".join(f"passage{i} word" for i in range(40))
ROWS = [
    (5, None), (1, ""), (2, "   \n\t "), (3, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."),
    (3, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."), (4, PASSAGE + "\nown line of four"),
    (6, "first line\n" + PASSAGE + "\n\nlast line"), (None, PASSAGE), (None, "alone"), (7, "é ñ 中文 \x00 　 x  y   z\x1c q <|endoftext|>"),
    (8, "ab " * 9000), (9, "a" * 30000), (10, "ONE two THREE four five six seven eight nine ten eleven twelve thirteen fourteen."), (5, None),
]
CLASHES = {"n_words": 1, "words": 2, "label": 3, "part": 4, "block": 5, "text_crc32": 6, "mark": 7, "shard": 8, "start": 9, "quality": 0}


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture
def space(shipped, request):
    return Workspace(shipped, "test")


@pytest.fixture(scope="session")
def odd(shipped):
    """The rows above in four partitions, with columns whose names the operators use themselves."""
    columns = ", ".join(f"`{k}` int" for k in CLASHES)
    rows = [(i, t, *CLASHES.values()) for i, t in ROWS]
    return shipped.createDataFrame(rows, f"doc_id bigint, text string, {columns}").repartition(4)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(shipped):
    return shipped.createDataFrame([(3, 1, 0), (4, 0, 1), (4, 1, 0), (None, 1, 0), (8, 0, 0), (9, None, 0)], "doc_id bigint, quality int, toxic int")

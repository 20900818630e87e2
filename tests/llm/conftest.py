import json

import numpy as np
import pytest


@pytest.fixture(scope="session")
def library():
    from tidemark.llm.bpe import default_path
    from tidemark.llm.bpe import library as load

    return load(default_path())


@pytest.fixture
def rng():
    return np.random.default_rng(5)


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def as_json(text):
    return json.loads(text)

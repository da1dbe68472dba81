import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import agree  # noqa: E402

from caresieve.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_corpus_query_agrees_with_its_oracle(spark, name):
    agree(spark, QUERIES[name], ORACLE[name])

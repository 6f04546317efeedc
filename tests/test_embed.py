"""Every row keeps its key, also where the encoder fails."""

import numpy as np
import pytest

from auric.operators import embed


def test_failing_rows_are_flagged(spark):
    def picky(texts, dim):  # a closure travels to the workers by value
        if any(t == "bad" for t in texts):
            raise RuntimeError("cannot encode")
        return np.ones((len(texts), dim))

    df = spark.createDataFrame([(k, "bad" if k == 3 else f"text {k}") for k in range(10)], "id long, t string").coalesce(1)
    got = {r.id: r for r in embed.encode(df, "id", "t", 4, picky, batch_size=5).collect()}
    assert sorted(got) == list(range(10))
    assert [k for k, r in got.items() if r.falhou] == [3] and got[3].embedding is None
    assert all(len(r.embedding) == 4 for k, r in got.items() if k != 3)


def test_wrong_length_fails_the_job(spark):
    with pytest.raises(Exception, match="dimensions"):
        embed.encode(spark.createDataFrame([(1, "a")], "id long, t string"), "id", "t", 4, lambda t, d: np.ones((len(t), 3))).collect()

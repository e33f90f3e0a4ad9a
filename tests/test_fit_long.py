from trolley.catalog import REGISTRY, models
from trolley.operators.rfm import WINDOWS_LONG


def test_all_origins_and_windows_are_trained_on(spark, monkeypatch):
    """Every origin but the newest, and the features of all windows; the newest is scored."""
    seen = {}

    def noted(train, score, columns, key):
        seen.update(train=train, score=score, columns=columns)
        return score.select(*key)

    monkeypatch.setattr(models.M, "fit_long", noted)
    REGISTRY["fit_long"].build(spark, "/root/testdata/sf0.01")
    assert sorted(r["origin"] for r in seen["train"].select("origin").distinct().collect()) == [2, 3, 4, 5, 6]
    assert {r["origin"] for r in seen["score"].select("origin").distinct().collect()} == {1}
    assert all(any(c.endswith(str(w)) for c in seen["columns"]) for w in WINDOWS_LONG), seen["columns"]

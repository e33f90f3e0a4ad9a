from trolley.operators import models


def test_factors_drop_the_shuffles_of_earlier_iterations(spark, monkeypatch):
    """Item factors are stored in every iteration, in a folder that is set by then: only so ALS drops what came before."""
    seen = {}

    class Noted(models.ALS):
        def fit(self, ratings):
            seen.update(interval=self.getCheckpointInterval(), folder=ratings.sparkSession.sparkContext.getCheckpointDir())
            return super().fit(ratings)

    monkeypatch.setattr(models, "ALS", Noted)
    model = models.fit_factors(spark.createDataFrame([(u, i, float(u + i)) for u in range(6) for i in range(5)], "user int, item int, rating double"), rank=2, iterations=2)
    assert model.userFactors.count() == 6
    assert seen["interval"] == 1 and seen["folder"]

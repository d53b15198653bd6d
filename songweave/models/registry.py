"""Models by name."""

from __future__ import annotations

from songweave.models.base import RetrievalModel
from songweave.models.decay import LastListenRecommender
from songweave.models.matrix import ALS, BM25, BPR
from songweave.models.overlap import ItemKNN
from songweave.models.popular import MostPopular, NewItemsLastNDays
from songweave.models.taste import KMeansEmbedding
from songweave.models.walk import RandomWalkWithRestart

MODELS: dict[str, type[RetrievalModel]] = {
    model.name: model
    for model in (
        MostPopular,
        NewItemsLastNDays,
        LastListenRecommender,
        ALS,
        BM25,
        ItemKNN,
        BPR,
        RandomWalkWithRestart,
        KMeansEmbedding,
    )
}


def initialize_model(name: str, **arguments) -> RetrievalModel:
    """A new model; an unknown name is an error, never a silently missing model."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(MODELS)}")
    return MODELS[name](**arguments)

"""Declared schemas of the film data; inference is left to audits."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


RATINGS = _schema(userId=T.LongType(), movieId=T.LongType(), rating=T.FloatType(), timestamp=T.LongType())
TAGS = _schema(userId=T.LongType(), movieId=T.LongType(), tag=T.StringType(), timestamp=T.LongType())
MOVIES = _schema(movieId=T.LongType(), title=T.StringType(), genres=T.StringType())
GENOME_SCORES = _schema(movieId=T.LongType(), tagId=T.IntegerType(), relevance=T.FloatType())
GENOME_TAGS = _schema(tagId=T.IntegerType(), tag=T.StringType())
FILM_LINKS = _schema(movieId=T.LongType(), imdbId=T.StringType(), tmdbId=T.StringType())
LINKS = _schema(
    osnr=T.DoubleType(), launch_power=T.DoubleType(), fiber_length=T.DoubleType(), dispersion=T.DoubleType(),
    nonlinear_effect=T.DoubleType(), q_factor=T.DoubleType(),
)

# Columns read as text whatever they look like; the rest of a building file is inferred.
BUILDING_TEXT = [
    "imb_id", "num_voie", "cp_no_voie", "type_voie", "nom_voie", "batiment", "code_insee", "code_poste",
    "nom_com", "catg_loc_imb", "imb_etat", "pm_ref", "pm_etat", "code_l331", "geom_mod", "type_imb",
]

"""The two jobs composed from the operators: music and fashion products."""

from sluice.plans.music import (
    clean_music,
    music_tables,
    publish_music,
    reshape_recommendations,
    run_music,
)
from sluice.plans.products import (
    clean_products,
    product_master,
    product_tables,
    publish_products,
    run_products,
)

__all__ = [
    "clean_music",
    "clean_products",
    "music_tables",
    "product_master",
    "product_tables",
    "publish_music",
    "publish_products",
    "reshape_recommendations",
    "run_music",
    "run_products",
]

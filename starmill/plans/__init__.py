"""The pipelines: warehouse load, roll-up with prediction fact, catalogue, recommender."""

from starmill.plans.catalogue import load_catalogue
from starmill.plans.warehouse import init_load
from starmill.plans.recommender import run_recommender
from starmill.plans.rollup import roll_up_addresses, rollup_and_predict

__all__ = ["init_load", "load_catalogue", "roll_up_addresses", "rollup_and_predict", "run_recommender"]

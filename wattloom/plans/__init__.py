"""Whole jobs: ingest, load modelling and day curves of simulated readings."""

from wattloom.plans.ingest import ingest
from wattloom.lineage import cut
from wattloom.plans.load_model import load_model
from wattloom.plans.simulated import day_curves

__all__ = ["cut", "day_curves", "ingest", "load_model"]

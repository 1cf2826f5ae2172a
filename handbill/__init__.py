"""handbill: many noisy feeds of event listings in, one ranked digest out, on Spark."""

from handbill.config import RunConfig, default_rules, load_rules
from handbill.plans.run import run_listings

__all__ = ["RunConfig", "default_rules", "load_rules", "run_listings"]

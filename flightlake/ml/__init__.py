"""Feature statistics, baselines, boosted trees, evaluation, batch scoring."""

"""Jobs: activity per role, replay, churn labels and statistics, training."""

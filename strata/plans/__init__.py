"""Layer plans: process (raw -> processed), curate (processed -> curated),
marts (curated -> analytics) and the end-to-end pipeline."""

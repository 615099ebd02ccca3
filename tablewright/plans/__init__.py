"""Entry points: training, batch scoring, registered queries."""

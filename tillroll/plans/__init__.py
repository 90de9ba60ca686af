"""Ready-made questions, cleaning of the raw tables and result publishing."""

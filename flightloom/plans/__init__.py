"""Query plans composed from the operators: the fact, its marts, the saved questions and the daily run."""

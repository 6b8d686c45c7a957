"""Representation learning trained in parallel: tasks compute gradients, Spark adds them up."""

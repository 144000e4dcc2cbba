"""Whole stages: build, train, evaluate, predict, explain."""

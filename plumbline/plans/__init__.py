"""Composed jobs: table cleaning, preprocessing, training and scoring."""

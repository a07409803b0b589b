"""Spark-native analytics over large labelled point clouds."""

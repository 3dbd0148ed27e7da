"""MLlib pipelines: age-group classifier, cancellation model, sales forecaster.

Every fit is a distributed MLlib job; driver-side loops run over features
or parameter grids (bounded by code), never over data rows.
"""

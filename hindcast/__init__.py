"""Hindcast: a Spark-native engine for hourly measurement series and the forecasts made about them."""

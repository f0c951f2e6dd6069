"""End-to-end plans: preprocess, features, forecast, inventory."""

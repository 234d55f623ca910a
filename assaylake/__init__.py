"""assaylake: Spark-native operators for measured, cited observations."""

__version__ = "0.1.0"

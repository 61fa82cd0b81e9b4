"""Real-time retail analytics on Spark: daily-active devices, order amounts,
sale detail, coupon-abuse alerts and the reports drawn from them."""

from tastemill.plans.cli import main

main()
